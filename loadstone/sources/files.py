"""File loads: file lists, patterns, the load-once ledger, history.

``load_history`` has one row per file: path, pipe, first/last insert time,
rows_parsed, rows_inserted, errors_seen, error_limit, complete, first error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IN_PROGRESS, LOADED, FAILED, PARTIALLY_LOADED = 1, 2, 3, 4


def wrapped_paths(spark: SparkSession, paths: list[tuple[str, int | None]]) -> DataFrame:
    """SRC2: (path, size); a null path or negative size is refused."""
    for path, size in paths:
        if path is None or (size is not None and size < 0):
            raise ValueError(f"not a file: path {path!r}, size {size!r}")
    return spark.createDataFrame(paths, "path string, size long")


def listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SRC2: (path, size) of the files below a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("length").alias("size"))


def by_pattern(files: DataFrame, pattern: str | None) -> tuple[DataFrame, DataFrame]:
    """SRC3: (files that match the regular expression, files that do not)."""
    if pattern is None:
        return files, files.where(F.lit(False))
    match = F.coalesce(F.col("path").rlike(pattern), F.lit(False))
    return files.where(match), files.where(~match)


def once_only(files: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC4: (files not loaded yet, files skipped because they are)."""
    done = ledger.select("path").distinct()
    return files.join(done, "path", "left_anti"), files.join(done, "path", "left_semi")


def file_status(history: DataFrame) -> DataFrame:
    """SNK12: adds status (1 in progress, 2 loaded, 3 failed, 4 partially loaded) and success; a file
    with errors that inserted no rows (``rows_inserted``, if there) failed."""
    none = (F.col("rows_inserted") == 0) if "rows_inserted" in history.columns else F.lit(False)
    status = (
        F.when(~F.col("complete"), IN_PROGRESS).when(F.col("errors_seen") == 0, LOADED)
        .when((F.col("errors_seen") >= F.col("rows_parsed")) | none, FAILED).otherwise(PARTIALLY_LOADED)
    )
    return history.withColumn("status", status).withColumn("success", F.col("status").isin(LOADED, PARTIALLY_LOADED))


def history_rows(rows: DataFrame, errors: DataFrame, pipe: str, at: Column, error_limit: int | None = None) -> DataFrame:
    """SNK13: one history row per file from its rows (path) and errors (path, line, character, column, message).

    A file with ``error_limit`` errors or more is not loaded: it inserts no
    rows.  Without a limit its good rows are.
    """
    parsed = rows.groupBy("path").agg(F.count("*").alias("rows_parsed"))
    first = errors.groupBy("path").agg(F.count("*").alias("errors_seen"), F.min(F.struct("line", "character", "column", "message")).alias("first_error"))
    out = parsed.join(first, "path", "left").withColumn("errors_seen", F.coalesce("errors_seen", F.lit(0)))
    limit = F.lit(error_limit).cast("long")
    inserted = F.when(F.coalesce(F.col("errors_seen") >= limit, F.lit(False)), 0).otherwise(F.col("rows_parsed") - F.col("errors_seen"))
    return out.select(
        "path", F.lit(pipe).alias("pipe"), at.alias("last_insert_time"), "rows_parsed", inserted.alias("rows_inserted"),
        "errors_seen", limit.alias("error_limit"), F.lit(True).alias("complete"), F.col("first_error.message").alias("first_error"),
        F.col("first_error.line").alias("first_error_line"), F.col("first_error.character").alias("first_error_character"), F.col("first_error.column").alias("first_error_column"),
    )


def history_since(history: DataFrame, now: Column, recent_seconds: int | None = None, mark: tuple | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """SNK10, ORD3: (entries after the mark and inside the recent window, the next mark as one row)."""
    out = history
    if recent_seconds is not None:
        out = out.where(F.col("last_insert_time") >= now - F.make_dt_interval(secs=F.lit(recent_seconds)))
    if mark is not None:
        out = out.where((F.col("last_insert_time") > F.lit(mark[0])) | ((F.col("last_insert_time") == F.lit(mark[0])) & (F.col("path") > F.lit(mark[1]))))
    if limit is not None:
        out = out.orderBy("last_insert_time", "path").limit(limit)
    return out, out.agg(F.max(F.struct("last_insert_time", "path")).alias("next_mark"))


def history_range(history: DataFrame, start: Column, end: Column) -> tuple[DataFrame, DataFrame]:
    """SNK11: (entries in [start, end), the range they cover and whether all are complete)."""
    out = history.where((F.col("last_insert_time") >= start) & (F.col("last_insert_time") < end))
    return out, out.agg(F.min("last_insert_time").alias("first_time"), F.max("last_insert_time").alias("last_time"), F.coalesce(F.every("complete"), F.lit(True)).alias("complete"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under ``spark.checkpoint.dir``, which all executors share."""
    for conf in (spark.conf, spark.sparkContext.getConf()):
        if shared := conf.get("spark.checkpoint.dir", None):
            return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="loadstone-")
    spark.conf.set("spark.checkpoint.dir", own)
    return f"{own}/{name}-{uuid.uuid4().hex}"
