"""Registered queries that write files, load them and tell what became of them.

The files are made from the given tables; folders are new for each run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadstone.operators import chunks, offsets
from loadstone.operators.conform import conform
from loadstone.plans.registry import query, read
from loadstone.plans.schema import missing_required, table_schema
from loadstone.sources import csv_lines, files, sink
from loadstone.streaming import stream

_SIZES = table_schema([{"name": "K", "logicalType": "FIXED", "physicalType": "SB8", "precision": 18, "scale": 0, "nullable": False}, {"name": "S", "logicalType": "FIXED", "physicalType": "SB4", "precision": 9, "scale": 0}])
SMALL_FILE_ROWS = 40_000  # of the files that are merged
_PART = "WITH p AS (SELECT regexp_replace(p_brand, '\\D', '', 'g') AS brand, p_partkey AS k, p_size AS s, p_partkey % 17 = 0 OR (p_brand = 'Brand#13') AS bad, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)"


def brand_files(spark: SparkSession, sf_dir: str) -> str:
    """part as one CSV file a brand (key, size) in order of keys; some sizes, and all of brand 13, are no numbers."""
    path = files.new_folder(spark, "csv")
    size = F.when((F.col("p_partkey") % 17 == 0) | (F.col("p_brand") == "Brand#13"), "honk").otherwise(F.col("p_size").cast("string"))
    rows = read(spark, sf_dir, "part").select(F.regexp_replace("p_brand", r"\D", "").alias("brand"), F.col("p_partkey").alias("k"), size.alias("s"))
    rows.repartition("brand").sortWithinPartitions("brand", "k").write.partitionBy("brand").csv(path)
    return path


def brand(path: str):
    return F.regexp_extract(path, r"brand=(\d+)/", 1)


def brand_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load history of the files of :func:`brand_files`, at times told by the brand."""
    found = [(r["path"], r["size"]) for r in files.listed(spark, brand_files(spark, sf_dir), "*.csv").collect()]
    asked = files.wrapped_paths(spark, found)
    new, _ = files.once_only(asked, asked.limit(0))
    rows = csv_lines.csv_as_rows(spark, sorted(r["path"] for r in new.collect()), _SIZES, "part")
    errors = csv_lines.error_places(rows, conform(csv_lines.records(rows), _SIZES, row="row_map").errors, _SIZES.names)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + brand("path").cast("long") * 60)
    return files.history_rows(rows, errors, "pipe", at, error_limit=5)


@query(f"""{_PART} SELECT brand, count(*) AS rows_parsed, CASE WHEN count(*) FILTER (WHERE bad) >= 5 THEN 0 ELSE count(*) FILTER (WHERE NOT bad) END AS rows_inserted, count(*) FILTER (WHERE bad) AS errors_seen, 5::BIGINT AS error_limit,
  CASE WHEN NOT bool_or(bad) THEN 2 WHEN bool_and(bad) OR count(*) FILTER (WHERE bad) >= 5 THEN 3 ELSE 4 END AS status, NOT bool_and(bad) AND count(*) FILTER (WHERE bad) < 5 AS success, min(n) FILTER (WHERE bad) AS line,
  min(length(k::VARCHAR) + 2) FILTER (WHERE bad AND n = first_bad) AS "character", CASE WHEN bool_or(bad) THEN 'S' END AS col,
  CASE WHEN bool_or(bad) THEN 'S: not a valid number(9,0)' END AS first_error FROM (SELECT *, min(CASE WHEN bad THEN n END) OVER (PARTITION BY brand) AS first_bad FROM p) x GROUP BY brand""")
def csv_load_history(spark, sf_dir):
    """SRC1, SRC2, SNK12, SNK13: files loaded, with the first error of each; five errors are too many"""
    told = files.file_status(brand_history(spark, sf_dir))
    return told.select(brand("path").alias("brand"), "rows_parsed", "rows_inserted", "errors_seen", "error_limit", "status", "success", F.col("first_error_line").alias("line"), F.col("first_error_character").alias("character"), F.col("first_error_column").alias("col"), "first_error")


@query(f"""{_PART} SELECT k, s FROM p WHERE NOT bad AND brand LIKE '1%' AND brand::INTEGER % 5 <> 0""")
def csv_load_once(spark, sf_dir):
    """SRC1, SRC3, SRC4: of the files that match a pattern those not loaded before"""
    asked = files.listed(spark, brand_files(spark, sf_dir), "*.csv")
    matched, _ = files.by_pattern(asked, r"brand=1\d?/")
    new, _ = files.once_only(matched, asked.where(brand("path").cast("int") % 5 == 0))
    rows = csv_lines.csv_as_rows(spark, sorted(r["path"] for r in new.collect()), _SIZES, "part")
    return conform(csv_lines.records(rows), _SIZES, row="row_map").good.select(F.col("K").cast("bigint").alias("k"), F.col("S").cast("int").alias("s"))


_LINES = """WITH l AS (SELECT regexp_replace(p_brand, '\\D', '', 'g') AS brand, p_partkey AS k, p_size AS s, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n,
    CASE WHEN p_partkey % 11 = 0 THEN 'few' WHEN p_partkey % 13 = 0 THEN 'many' WHEN p_partkey % 17 = 0 THEN 'open' WHEN p_partkey % 19 = 0 THEN 'after' WHEN p_partkey % 23 = 0 THEN 'value' WHEN p_partkey % 5 = 0 THEN 'quoted' ELSE 'plain' END AS kind FROM part)"""


def broken_files(spark: SparkSession, sf_dir: str) -> str:
    """part as text files, one a brand, in order of keys: key and size; some lines lack a field, have
    one too many, do not close a quote, go on after it, or hold no number."""
    path = files.new_folder(spark, "broken")
    k, s = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    line = F.when(F.col("p_partkey") % 11 == 0, k)
    for by, made in ((13, F.concat_ws(",", k, s, s)), (17, F.concat(k, F.lit(',"'), s)), (19, F.concat(F.lit('"'), k, F.lit('"x,'), s)), (23, F.concat_ws(",", k, F.lit("honk"))), (5, F.concat(F.lit('"'), k, F.lit('","'), s, F.lit('"')))):
        line = line.when(F.col("p_partkey") % by == 0, made)
    rows = read(spark, sf_dir, "part").select(F.regexp_replace("p_brand", r"\D", "").alias("brand"), "p_partkey", line.otherwise(F.concat_ws(",", k, s)).alias("value"))
    rows.repartition("brand").sortWithinPartitions("brand", "p_partkey").drop("p_partkey").write.partitionBy("brand").text(path)
    return path


@query(f"""{_LINES} SELECT brand, n AS line, CASE kind WHEN 'few' THEN length(k::VARCHAR) + 1 WHEN 'many' THEN length(k::VARCHAR) + length(s::VARCHAR) + 3 WHEN 'after' THEN length(k::VARCHAR) + 3 ELSE length(k::VARCHAR) + 2 END AS "character",
  CASE kind WHEN 'many' THEN NULL WHEN 'after' THEN 'K' ELSE 'S' END AS col, CASE kind WHEN 'value' THEN '0030' ELSE '0004' END AS code,
  CASE kind WHEN 'few' THEN '1 of 2 columns' WHEN 'many' THEN '3 columns instead of 2' WHEN 'open' THEN 'a quote is not closed' WHEN 'after' THEN 'text after a closing quote' ELSE 'S: not a valid number(9,0)' END AS message
  FROM l WHERE kind NOT IN ('plain', 'quoted')""")
def csv_bad_lines(spark, sf_dir):
    """SRC1, SNK13: the line, character and column of every line that is no record or holds a bad value"""
    rows = csv_lines.csv_as_rows(spark, broken_files(spark, sf_dir), _SIZES, "part")
    told = csv_lines.error_places(rows, conform(csv_lines.records(rows), _SIZES, row="row_map").errors, _SIZES.names)
    return told.select(brand("path").alias("brand"), "line", "character", F.col("column").alias("col"), "code", "message")


@query(f"""{_LINES}, c AS (SELECT brand, count(*) FILTER (WHERE kind NOT IN ('plain', 'quoted')) AS bad FROM l GROUP BY brand)
  SELECT k, s FROM l JOIN c ON l.brand = c.brand WHERE kind IN ('plain', 'quoted') AND bad < 22""")
def csv_error_limit(spark, sf_dir):
    """SRC1, SNK13: the rows of the files with fewer errors than the limit"""
    rows = csv_lines.csv_as_rows(spark, broken_files(spark, sf_dir), _SIZES, "part")
    checked = conform(csv_lines.records(rows), _SIZES, row="row_map")
    history = files.history_rows(rows, csv_lines.error_places(rows, checked.errors, _SIZES.names), "pipe", F.current_timestamp(), error_limit=22)
    return csv_lines.within_limit(checked.good, history).select(F.col("K").cast("bigint").alias("k"), F.col("S").cast("int").alias("s"))


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 7 AS extra, c_nationkey AS f FROM customer)
  SELECT k, f AS file, 1 + coalesce(sum(1 + extra) OVER (PARTITION BY f ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line, extra::INTEGER AS breaks FROM c""")
def csv_quoted_breaks(spark, sf_dir):
    """SRC1: records whose quoted field holds line breaks, and the line where each starts"""
    path = files.new_folder(spark, "breaks")
    note = F.concat(F.lit('"'), F.repeat(F.lit('a ""b"",\n'), (F.col("c_custkey") % 7).cast("int")), F.lit('"'))
    rows = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("file"), "c_custkey", F.concat(F.col("c_custkey").cast("string"), F.lit(","), note).alias("value"))
    rows.repartition("file").sortWithinPartitions("file", "c_custkey").drop("c_custkey").write.partitionBy("file").text(path)
    notes = table_schema([{"name": "K", "logicalType": "FIXED", "physicalType": "SB8", "precision": 18, "scale": 0}, {"name": "NOTE", "logicalType": "TEXT", "length": 1000}])
    told = csv_lines.csv_as_rows(spark, path, notes, "customer", multi_line=True).where(F.col("problem").isNull())
    count = F.length(F.col("row_map")['"NOTE"']) - F.length(F.replace(F.col("row_map")['"NOTE"'], F.lit("\n"), F.lit("")))
    return told.select(F.col("row_map")['"K"'].cast("bigint").alias("k"), F.regexp_extract("path", r"file=(\d+)/", 1).cast("bigint").alias("file"), F.col("row_index").alias("line"), count.alias("breaks"))


@query("""WITH h AS (SELECT DISTINCT regexp_replace(p_brand, '\\D', '', 'g') AS brand FROM part), r AS (SELECT brand, row_number() OVER (ORDER BY brand::INTEGER) AS n FROM h WHERE brand::INTEGER >= 20)
  SELECT brand, CASE WHEN n <= 2 THEN 1 ELSE 2 END AS page FROM r WHERE n <= 4""")
def history_pages(spark, sf_dir):
    """SNK10, ORD3: the history of the last 40 minutes, two entries a page, each from the mark before"""
    history = brand_history(spark, sf_dir).withColumn("path", brand("path"))
    now = F.timestamp_seconds(F.lit(1_700_000_000 + 60 * 60))
    first, mark = files.history_since(history, now, 40 * 60, None, 2)
    last = mark.first()["next_mark"]
    second, _ = files.history_since(history, now, 40 * 60, (last["last_insert_time"], last["path"]), 2)
    return first.select(F.col("path").alias("brand"), F.lit(1).alias("page")).union(second.select("path", F.lit(2)))


@query("SELECT DISTINCT regexp_replace(p_brand, '\\D', '', 'g') AS brand FROM part WHERE regexp_replace(p_brand, '\\D', '', 'g')::INTEGER % 3 = 0")
def files_waiting(spark, sf_dir):
    """JOIN5: requested files without a complete entry in the history"""
    asked = files.listed(spark, brand_files(spark, sf_dir), "*.csv")
    history = asked.withColumn("complete", brand("path").cast("int") % 3 != 0)
    return offsets.pending_files(asked, history).select(brand("path").alias("brand"))


@query(f"""{_PART} SELECT k, CASE WHEN NOT bad THEN s END AS s FROM p""")
def csv_arrival(spark, sf_dir):
    """STR14: files of a pipe as they arrive, each once, over two runs of the stream"""
    path, out = brand_files(spark, sf_dir), files.new_folder(spark, "arrived")
    for _ in range(2):
        writer = stream.csv_stream(spark, path, "k long, s int").writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint")
        writer.trigger(**stream.trigger(available_now=True)).start().awaitTermination()
    return spark.read.parquet(f"{out}/data").select("k", "s")


# --- written chunks ----------------------------------------------------------------------


def flag_chunks(spark: SparkSession, sf_dir: str) -> str:
    """lineitem as Parquet chunks of a return flag each: one, or several where a flag has more rows than a file takes."""
    path = files.new_folder(spark, "chunks")
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_linestatus")
    sink.write_chunks(rows.withColumn("flag", F.col("l_returnflag")), path, ["flag"], order=["l_orderkey", "l_linenumber"])
    return path


@query("""WITH g AS (SELECT l_returnflag AS flag, count(*) AS n, min(l_partkey) AS a, max(l_partkey) AS b, min(l_tax) AS c, max(l_tax) AS d, min(l_linestatus) AS e, max(l_linestatus) AS f, min(l_orderkey) AS g, max(l_orderkey) AS h, min(l_linenumber) AS i, max(l_linenumber) AS j FROM lineitem GROUP BY ALL)
  SELECT flag, 'l_partkey' AS "column", n AS row_count, a::BIGINT AS low, b::BIGINT AS high, 0.0::DOUBLE AS high_real, NULL AS high_string, true AS sound FROM g
  UNION ALL SELECT flag, 'l_orderkey', n, g, h, 0.0, NULL, true FROM g UNION ALL SELECT flag, 'l_linenumber', n, i, j, 0.0, NULL, true FROM g
  UNION ALL SELECT flag, 'l_tax', n, 0, 0, d, NULL, true FROM g UNION ALL SELECT flag, 'l_linestatus', n, 0, 0, 0.0, lower(hex(encode(f))), true FROM g
  UNION ALL SELECT flag, 'l_returnflag', n, 0, 0, 0.0, lower(hex(encode(flag))), true FROM g""")
def manifest_statistics(spark, sf_dir):
    """SNK1, SNK4, SNK5: the manifest of written files, with the statistics of each column; those of the files of a flag are put together"""
    path = flag_chunks(spark, sf_dir)
    told = sink.manifest(spark, path, "lineitem")
    again = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("_p"), F.md5("content").alias("_md5"), F.octet_length("content").alias("_n"))
    told = told.join(again, F.col("path") == F.col("_p")).withColumn("sound", (F.col("md5") == F.col("_md5")) & (F.col("length") == F.col("_n")) & (F.col("version") == sink.VERSION))
    flag = F.regexp_extract("path", r"flag=(\w)/", 1).alias("flag")
    rows = told.select(flag, "row_count", "sound", F.explode("columns").alias("c")).where("c.column <> 'flag'")
    return rows.groupBy("flag", "c.column").agg(
        F.sum("row_count").alias("row_count"), F.min("c.min_int").cast("bigint").alias("low"), F.max("c.max_int").cast("bigint").alias("high"),
        F.max("c.max_real").alias("high_real"), F.max("c.max_string").alias("high_string"), F.every("sound").alias("sound"),
    )


@query("""SELECT l_returnflag = 'N' AS apart, count(DISTINCT l_returnflag) AS chunks, count(*)::BIGINT AS row_count, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN 'done' ELSE 'open' END) > 1 AS mixed_tables, 1 AS version,
  string_agg(DISTINCT l_returnflag || ' ' || CASE WHEN l_linestatus = 'F' THEN 'done' ELSE 'open' END, ',' ORDER BY l_returnflag || ' ' || CASE WHEN l_linestatus = 'F' THEN 'done' ELSE 'open' END) AS held FROM lineitem GROUP BY ALL""")
def manifest_of_blobs(spark, sf_dir):
    """SNK4: chunks nested into their files, and whether a file holds more than one table"""
    rows = read(spark, sf_dir, "lineitem").withColumn("table", F.when(F.col("l_linestatus") == "F", "done").otherwise("open"))
    made = rows.groupBy((F.col("l_returnflag") == "N").alias("blob"), F.col("l_returnflag").alias("chunk_id"), "table").agg(F.count("*").alias("row_count"), F.sum("l_linenumber").alias("bytes"), F.md5(F.min("l_linestatus")).alias("md5"))
    told = sink.blob_manifest(made)
    held = F.array_join(F.transform("chunks", lambda c: F.concat_ws(" ", c["chunk_id"], c["table"])), ",")
    count = F.size(F.array_distinct(F.transform("chunks", lambda c: c["chunk_id"]))).cast("bigint")
    return told.select(F.col("blob").alias("apart"), count.alias("chunks"), "row_count", "mixed_tables", "version", held.alias("held"))


@query("""WITH l AS (SELECT l_returnflag AS flag, l_orderkey AS k, l_linenumber AS n FROM lineitem)
  SELECT flag, count(*) AS rows, count(DISTINCT (k, n)) AS distinct_rows, 0::BIGINT AS duplicates, count(*) AS after_a_second_merge, true AS in_order, true AS fewer_files FROM l GROUP BY ALL""")
def merged_files(spark, sf_dir):
    """SNK8, SNK9, AGG17, ORD1: small files packed into fewer, rows in the order they had and known by
    the identity stored with them; what a second merge of the same files would double.

    Small files have a bounded number of rows, so a larger table has more of them, not larger ones.
    """
    path, to = files.new_folder(spark, "chunks"), files.new_folder(spark, "merged")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"))
    small = max(16, -(-rows.count() // SMALL_FILE_ROWS))
    sink.write_chunks(sink.identified(rows.repartition(small, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber")), path)
    sink.merge_files(spark, [path], f"{to}/a", target_bytes=1 << 20)
    merged = spark.read.parquet(f"{to}/a").withColumns({"_file": F.col("_metadata.file_path"), "_place": F.col("_metadata.row_index")})
    fewer = files.listed(spark, f"{to}/a", "*.parquet").count() < files.listed(spark, path, "*.parquet").count()
    before = F.lag("row_number").over(Window.partitionBy("_file", "file_id").orderBy("_place"))
    told = merged.withColumn("_ok", F.coalesce(before < F.col("row_number"), F.lit(True))).groupBy("flag").agg(
        F.count("*").alias("rows"), F.count_distinct("l_orderkey", "l_linenumber").alias("distinct_rows"), F.every("_ok").alias("in_order"))
    twice = spark.read.parquet(f"{to}/a").union(spark.read.parquet(f"{to}/a"))
    counts = [sink.duplicate_rows(d).groupBy("flag").agg(F.count("*").alias(n)) for d, n in ((merged, "duplicates"), (twice, "after_a_second_merge"))]
    for c in counts:
        told = told.join(c, "flag", "left")
    return told.fillna(0, ["duplicates", "after_a_second_merge"]).withColumn("fewer_files", F.lit(fewer))


@query("""WITH e AS (SELECT event_id, epoch_us(ts) // 1000000 AS s, md5((event_id // 100)::VARCHAR) AS h FROM events),
  d AS (SELECT *, '0123456789abcdefghijklmnopqrstuvwxyz' AS a FROM e)
  SELECT event_id, strftime(make_timestamp(s * 1000000), '%Y/%m/%d/%H/%M/') || substr(a, (s // 60466176 % 36 + 1)::INT, 1) || substr(a, (s // 1679616 % 36 + 1)::INT, 1) || substr(a, (s // 46656 % 36 + 1)::INT, 1) || substr(a, (s // 1296 % 36 + 1)::INT, 1)
    || substr(a, (s // 36 % 36 + 1)::INT, 1) || substr(a, (s % 36 + 1)::INT, 1) || '_client_7_' || event_id AS by_time, 'events/' || substr(h, 1, 2) || '/' || event_id // 100 AS by_table FROM d""")
def file_paths(spark, sf_dir):
    """SNK2, SNK3: where files go, by UTC time and by table"""
    # the wall clock as the same clock in UTC, whatever the session's zone
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    rows = read(spark, sf_dir, "events").withColumn("at", utc.cast("timestamp"))
    shown = F.to_utc_timestamp("at", F.current_timezone())
    by_time = F.concat_ws("/", *sink.time_path(shown), F.element_at(F.split(sink.blob_path(F.col("at"), F.lit("client"), F.lit(7), F.col("event_id")), "/"), -1))
    return rows.select("event_id", by_time.alias("by_time"), sink.table_path(F.lit("events"), F.floor(F.col("event_id") / 100)).alias("by_table"))


@query("""WITH f AS (SELECT event_type, event_id // 100 AS blob, sum(user_id)::BIGINT AS bytes, count(*) AS row_count, (sum(user_id) % 1000)::BIGINT AS build_ms, (sum(user_id) % 777 + 1)::BIGINT AS upload_ms FROM events GROUP BY ALL)
  SELECT event_type, count(*) AS files, sum(bytes)::BIGINT AS bytes, sum(row_count)::BIGINT AS rows, round(avg(build_ms), 6) AS build_mean, quantile_disc(build_ms, 0.5) AS build_p50, quantile_disc(build_ms, 0.99) AS build_p99, round(sum(bytes) * 1000.0 / sum(upload_ms), 6) AS bytes_per_second FROM f GROUP BY ALL""")
def ingest_metrics(spark, sf_dir):
    """AGG18: latencies, throughput and sizes of files"""
    e = read(spark, sf_dir, "events")
    made = e.groupBy("event_type", F.floor(F.col("event_id") / 100).alias("blob")).agg(F.sum("user_id").alias("bytes"), F.count("*").alias("row_count"))
    made = made.withColumns({"build_ms": F.col("bytes") % 1000, "upload_ms": F.col("bytes") % 777 + 1})
    told = sink.ingest_metrics(made, ["event_type"])
    return told.select("event_type", "files", "bytes", "rows", F.round("build_ms_mean", 6).alias("build_mean"), F.col("build_ms_p50").alias("build_p50"), F.col("build_ms_p99").alias("build_p99"), F.round("bytes_per_second", 6).alias("bytes_per_second"))


@query("""WITH f AS (SELECT event_type AS "table", event_id // 100 AS seq, count(*) AS row_count, sum(octet_length(encode(props)))::BIGINT AS bytes, min(ts) AS a, max(ts) AS b FROM events GROUP BY ALL)
  SELECT "table", seq // 10 AS chunk_no, sum(row_count)::BIGINT AS row_count, sum(bytes)::BIGINT AS bytes, count(*) AS flushes, epoch_us(min(a)) AS first_us, epoch_us(max(b)) AS last_us FROM f GROUP BY ALL""")
def chunk_totals(spark, sf_dir):
    """AGG12, AGG16: rows, bytes and insert times of the chunks of a table"""
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    e = read(spark, sf_dir, "events").withColumn("us", F.unix_micros(utc.cast("timestamp")))
    flushes = e.groupBy(F.col("event_type").alias("table"), F.floor(F.col("event_id") / 100).alias("seq")).agg(F.count("*").alias("row_count"), F.sum(F.octet_length("props")).cast("bigint").alias("bytes"), F.min("us").alias("first_insert"), F.max("us").alias("last_insert"))
    told = chunks.chunk_totals(flushes.withColumn("chunk_no", F.floor(F.col("seq") / 10)))
    return told.select("table", "chunk_no", "row_count", "bytes", "flushes", F.col("first_insert").alias("first_us"), F.col("last_insert").alias("last_us"))


@query("""SELECT user_id % 2 AS old, count(*) AS rows, count(*) FILTER (WHERE user_id % 2 = 0) AS with_props FROM events GROUP BY ALL""")
def concatenated_channels(spark, sf_dir):
    """SET1, SET2: rows of channels of one table, of which one does not have a column yet"""
    e = read(spark, sf_dir, "events").withColumn("table", F.lit("events"))
    out = chunks.concatenate(e.where("user_id % 2 = 0"), e.where("user_id % 2 = 1").drop("props"), evolved=True)
    return out.groupBy((F.col("user_id") % 2).alias("old")).agg(F.count("*").alias("rows"), F.count("props").alias("with_props"))


@query("""SELECT event_type, 'V1' AS version, 'PROPS' AS missing, count(*) AS rows FROM events WHERE user_id % 2 = 1 GROUP BY ALL UNION ALL SELECT event_type, 'V2', '', count(*) FROM events WHERE user_id % 2 = 0 GROUP BY ALL""")
def evolved_files(spark, sf_dir):
    """SCH8, SET3: files of two schema versions, and what each lacks of the columns now required"""
    path = files.new_folder(spark, "evolved")
    now = table_schema([{"name": "event_id", "logicalType": "FIXED", "physicalType": "SB8", "nullable": False}, {"name": "props", "logicalType": "VARIANT", "nullable": False}])
    e = read(spark, sf_dir, "events")
    made = {"V1": e.where("user_id % 2 = 1").select(F.col("event_id").alias("EVENT_ID"), "event_type"), "V2": e.where("user_id % 2 = 0").select(F.col("event_id").alias("EVENT_ID"), F.col("props").alias("PROPS"), "event_type")}
    out = None
    for version, rows in made.items():
        sink.write_chunks(rows, f"{path}/{version}")
        back = spark.read.parquet(f"{path}/{version}")
        lacks = ",".join(missing_required(back.columns, now)).upper()
        told = back.groupBy("event_type").agg(F.lit(version).alias("version"), F.lit(lacks).alias("missing"), F.count("*").alias("rows"))
        out = told if out is None else out.unionByName(told)
    return out
