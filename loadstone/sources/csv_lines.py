"""CSV files by line: every record with the true number of its line, and every
line that is no record with the character and column where it breaks.

Lines are numbered without reading a file in one task: each split counts its
lines, and the counts of the splits before it in its file are added.  With
``multi_line`` a quoted field may hold line breaks; whether a line starts inside
quotes is the parity of the quotes before it, a running sum over the file by ranges.

A field is bare, or in quotes with inner quotes doubled.  A bare empty
field is null.  Blank lines are no records, but count as lines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loadstone.functions.coerce import BAD_TYPE
from loadstone.operators.scans import scan, stored

RECORD_LINES = 10_000  # lines of one record; a quote that is open longer is not closed


def numbered_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """path, line (from 1), text of every line of the files, as a stored table."""
    meta = F.col("_metadata")
    lines = spark.read.text(paths).select(meta["file_path"].alias("path"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    lines = stored(lines, "lines")
    counts = lines.groupBy("path", "split").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select("path", "split", before.alias("base"))
    inside = F.row_number().over(Window.partitionBy("path", "split").orderBy("id"))
    return lines.withColumn("_inside", inside).join(base, ["path", "split"]).select("path", (F.col("base") + F.col("_inside")).alias("line"), "text")


def joined_lines(lines: DataFrame, quote: str = '"', most: int = RECORD_LINES) -> DataFrame:
    """Lines joined to records over quoted line breaks: path, line (the first), text.

    A quote that the file never closes, or not within ``most`` lines, opens nothing: its line
    stands alone, and so do the lines after it.
    """
    odd = (F.length("text") - F.length(F.replace("text", F.lit(quote), F.lit("")))) % 2
    rows = scan(lines, ["path"], ["line"], {"odds": ("sum", odd)}).withColumn("before", F.col("odds") - odd)
    last = rows.groupBy("path").agg(F.max("odds").alias("all_odds"))
    rows = rows.join(last, "path")
    apart = (F.col("before") % 2 == 0) | ((F.col("all_odds") % 2 == 1) & (F.col("before") == F.col("all_odds")))
    rows = stored(scan(rows.select("path", "line", "text", apart.cast("long").alias("_starts")), ["path"], ["line"], {"record": ("sum", F.col("_starts"))}), "records")
    lengths = rows.groupBy("path", "record").agg(F.count("*").alias("_lines"))
    long = lengths.where(F.col("_lines") > most).select("path", "record")
    whole = rows.join(long, ["path", "record"], "left_anti").groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("_all"))
    whole = whole.select("path", F.col("_all")[0]["line"].alias("line"), F.array_join(F.transform("_all", lambda x: x["text"]), "\n").alias("text"))
    return whole.union(rows.join(long, ["path", "record"], "left_semi").select("path", "line", "text"))


def parsed_records(records: DataFrame, names: list[str], sep: str = ",", quote: str = '"') -> DataFrame:
    """Adds to records (path, line, text): ``values`` (a field a name), ``starts`` (the
    character where each field starts, from 1) and ``problem``: null, or struct (code, character, column, message)."""
    s, q, n = re.escape(sep), re.escape(quote), len(names)
    quoted, bare = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}", f"(?!{q})[^{s}]*+"
    text = F.concat(F.lit(sep), "text")
    plain = ~F.contains("text", F.lit(quote))
    rows = records.where(F.length(F.btrim("text")) > 0)
    # what can be read: fields one after another, each after a separator
    good = F.when(plain, text).otherwise(F.regexp_extract(text, f"^(?:{s}(?:{quoted}(?={s}|$)|{bare}))*+", 0))
    rows = rows.withColumn("_good", good)
    rows = rows.withColumn("_raw", F.when(plain, F.split("text", f"[{s}]" if sep != "^" else r"\^", -1)).otherwise(F.regexp_extract_all("_good", F.lit(f"{s}({quoted}|{bare})"), F.lit(1))))
    rows = rows.withColumn("_count", F.size("_raw"))
    rows = rows.withColumn("_ends", F.aggregate("_raw", F.array(F.lit(1)), lambda seen, x: F.concat(seen, F.array(F.element_at(seen, -1) + F.length(x) + len(sep)))))
    stuck = F.length("_good") < F.length(text)
    rest = F.substring(text, F.length("_good") + 1 + len(sep), F.length(text))  # the field that cannot be read
    closed = F.length(F.regexp_extract(rest, f"^{quoted}", 0))
    at = F.length("_good") + 1
    named = lambda k: F.when(k <= n, F.element_at(F.array(*map(F.lit, names)), F.least(k, F.lit(n))))
    problem = lambda character, column, message: F.struct(F.lit(BAD_TYPE).alias("code"), character.cast("long").alias("character"), column.alias("column"), message.alias("message"))
    told = (
        F.when(stuck & (closed == 0), problem(at, named(F.col("_count") + 1), F.lit("a quote is not closed")))
        .when(stuck, problem(at + closed, named(F.col("_count") + 1), F.lit("text after a closing quote")))
        .when(F.col("_count") < n, problem(F.length("text") + 1, named(F.col("_count") + 1), F.concat(F.col("_count").cast("string"), F.lit(f" of {n} columns"))))
        .when(F.col("_count") > n, problem(F.get("_ends", F.lit(n)), F.lit(None).cast("string"), F.concat(F.col("_count").cast("string"), F.lit(f" columns instead of {n}"))))
    )
    unquoted = lambda x: F.when(F.startswith(x, F.lit(quote)), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit(quote * 2), F.lit(quote))).when(F.length(x) > 0, x)
    rows = rows.withColumns({"problem": told, "values": F.transform("_raw", unquoted), "starts": F.slice("_ends", 1, n)})
    return rows.drop("_good", "_raw", "_count", "_ends")


def csv_as_rows(spark: SparkSession, paths: list[str] | str, schema: T.StructType, table: str, sep: str = ",", quote: str = '"', header: bool = False, multi_line: bool = False) -> DataFrame:
    """SRC1: CSV records as raw rows for ``conform``: the file is the channel and batch, the line the
    row index, all values are strings; with path, starts, and ``problem`` where a line is no record.

    Stored, as rows and errors are both taken from it.
    """
    lines = numbered_lines(spark, paths)
    if header:
        lines = lines.where("line > 1")
    rows = parsed_records(joined_lines(lines, quote) if multi_line else lines, [f.name for f in schema.fields], sep, quote)
    value = lambda k: F.get("values", F.lit(k))
    values = F.when(F.col("problem").isNull(), F.create_map(*[x for k, f in enumerate(schema.fields) for x in (F.lit(f'"{f.name}"'), value(k))]))
    return stored(rows.select(F.lit(table).alias("table"), F.col("path").alias("channel"), F.lit(0).cast("long").alias("batch_id"), F.col("line").alias("row_index"), values.alias("row_map"), "path", "starts", "problem"), "csv_rows")


def records(rows: DataFrame) -> DataFrame:
    """The rows of :func:`csv_as_rows` that are records, for ``conform``."""
    return rows.where(F.col("problem").isNull()).drop("starts", "problem")


def error_places(rows: DataFrame, errors: DataFrame, names: list[str]) -> DataFrame:
    """SNK13: path, line, character, column, code, message of every line that is no record and of
    every error of ``conform`` (``errors``: channel, row_index, code, message)."""
    broken = rows.where(F.col("problem").isNotNull()).select("path", F.col("row_index").alias("line"), "problem.character", "problem.column", "problem.code", "problem.message")
    column = F.regexp_extract("message", r"^([^:]*):", 1)
    told = errors.select(F.col("channel").alias("path"), F.col("row_index").alias("line"), column.alias("column"), "code", "message")
    place = F.get("starts", F.array_position(F.array(*map(F.lit, names)), F.col("column")).cast("int") - 1)
    told = told.join(rows.select("path", F.col("row_index").alias("line"), "starts"), ["path", "line"])
    return broken.unionByName(told.select("path", "line", F.coalesce(place, F.lit(1)).cast("long").alias("character"), "column", "code", "message"))


def within_limit(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Rows (channel: their file) of the files that were loaded: one with as many errors as its ``error_limit`` gives none."""
    return rows.join(history.where("rows_inserted > 0").select(F.col("path").alias("channel")), "channel", "left_semi")

