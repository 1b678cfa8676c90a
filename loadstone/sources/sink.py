"""Writing chunks: Parquet files of bounded size, manifest, verification, row identity, compaction.

The append to the manifest is the commit: readers take files from it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadstone.operators import stats

VERSION = 1
TRIES = 3
MAX_FILE_BYTES = 256 * 1024 * 1024
MEASURED_ROWS = 10_000  # rows that tell how wide rows are
PIECE = 8 << 20  # bytes of a file that are read at a time
STREAMED = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")  # schemes that workers read by themselves


class VerificationFailed(RuntimeError):
    """Written files do not hold what was to be written."""


def time_path(at: Column) -> list[Column]:
    """SNK2: partition columns y, m, d, h, mi of a UTC time."""
    return [F.date_format(at, p).alias(n) for n, p in (("y", "yyyy"), ("m", "MM"), ("d", "dd"), ("h", "HH"), ("mi", "mm"))]


def blob_path(at: Column, prefix: Column, writer: Column, counter: Column) -> Column:
    """SNK2: ``y/m/d/h/min/<base36 second>_<prefix>_<writer>_<counter>`` of a UTC time."""
    second = F.lower(F.conv(F.unix_seconds(at).cast("string"), 10, 36))
    return F.concat_ws("/", *time_path(at), F.concat_ws("_", second, prefix, writer.cast("string"), counter.cast("string")))


def spread_prefix(chunk_id: Column) -> Column:
    """SNK3: two hex characters that spread the files of a table."""
    return F.substring(F.md5(chunk_id.cast("string")), 1, 2)


def table_path(table: Column, chunk_id: Column) -> Column:
    """SNK3: ``<table>/<two hex characters>/<chunk>``."""
    return F.concat_ws("/", table, spread_prefix(chunk_id), chunk_id.cast("string"))


def row_bytes(df: DataFrame) -> float:
    """Mean bytes of a row as JSON text, which is wider than it is in a file, of the first rows."""
    told = df.limit(MEASURED_ROWS).agg(F.avg(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))).first()[0]
    return max(told or 1.0, 1.0)


def write_chunks(
    df: DataFrame, path: str, partition_by: list[str] | None = None, iceberg: bool = False, order: list[str] | None = None, files: int | None = None, dictionary: bool = True, max_file_bytes: int = MAX_FILE_BYTES,
) -> None:
    """SNK1, ORD1: Parquet, gzip (zstd for Iceberg tables), rows of a channel in arrival order.

    With ``partition_by`` rows are rebalanced by these columns: values of few rows share
    a task, one with very many is dealt over many, and no file takes more
    rows than fill ``max_file_bytes`` at their measured width.
    """
    by = partition_by or []
    most = max(1, int(max_file_bytes / row_bytes(df))) if by else 0
    if by:
        df = df.repartition(files, *[F.col(c) for c in by]) if files else df.hint("rebalance", *[F.col(c) for c in by])
    elif files:
        df = df.repartition(files)
    if order:
        df = df.sortWithinPartitions(*by, *order)
    writer = df.write.mode("append").option("compression", "zstd" if iceberg else "gzip").option("parquet.enable.dictionary", str(dictionary).lower()).option("maxRecordsPerFile", most)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def file_digests(files: DataFrame) -> DataFrame:
    """SNK5: adds md5 to files (path, length), which are read in pieces of :data:`PIECE` bytes, whatever their size.

    Each path is a row; rows are dealt over tasks by path.  The scheme must be one of
    :data:`STREAMED`; ``manifest`` takes other files as one value, up to 2 GB.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for path in batch.column(0).to_pylist():
                # Spark writes file:/folder for file:///folder
                system, inside = pyarrow.fs.FileSystem.from_uri(path.removeprefix("file:") if path.startswith("file:/") else path.replace("s3a://", "s3://", 1))
                seen = hashlib.md5(usedforsecurity=False)
                with system.open_input_stream(inside, buffer_size=0) as stream:
                    while piece := stream.read(PIECE):
                        seen.update(piece)
                told.append(seen.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told, pa.string())], names=["path", "length", "md5"])

    return files.select("path", "length").repartition("path").mapInArrow(run, "path string, length long, md5 string")


def row_digest(columns: list[str]) -> Column:
    """A sum over rows that any change of a value changes, whatever their order."""
    return F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)"))


def manifest(spark: SparkSession, path: str, table: str = "", iceberg: bool = False) -> DataFrame:
    """SNK4, SNK5: one row per written file: table, path, length, md5, row_count, version and the
    statistics of its columns as registered.

    MD5 is taken in pieces, so a file may have any size.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    streamed = path.split(":/", 1)[0] in STREAMED or ":/" not in path
    files = file_digests(listed) if streamed else listed.select("path", "length", F.md5("content").alias("md5"))
    # both give the path in a form of their own; what follows the folder is the same
    below = lambda c: F.substring_index(c, path.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    rows = spark.read.parquet(path)
    measured = stats.file_properties(stats.column_stats(rows.withColumn("_file", below(F.col("_metadata.file_path"))), ["_file"]), iceberg)
    each = F.struct(*[c for c in measured.columns if c not in ("_file", "row_count")])
    told = measured.groupBy("_file").agg(F.max("row_count").alias("row_count"), F.array_sort(F.collect_list(each)).alias("columns"))
    joined = files.withColumn("_file", below(F.col("path"))).join(told, "_file", "left")
    return joined.select(F.lit(table).alias("table"), "path", "length", "md5", F.coalesce("row_count", F.lit(0)).alias("row_count"), F.lit(VERSION).alias("version"), "columns")


def blob_manifest(chunks: DataFrame) -> DataFrame:
    """SNK4: chunks (blob, table, chunk_id, row_count, bytes, md5[, columns]) nested into one row per file, with the mixed-table flag."""
    fields = [c for c in ("chunk_id", "table", "row_count", "bytes", "md5", "columns") if c in chunks.columns]
    return chunks.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("chunks"), F.sum("row_count").alias("row_count"), F.sum("bytes").alias("bytes"),
        (F.min("table") != F.max("table")).alias("mixed_tables"), F.lit(VERSION).alias("version"),
    )


def write_verified(df: DataFrame, path: str, partition_by: list[str] | None = None, iceberg: bool = False) -> dict[str, int]:
    """SNK6, SNK7: write, then hold count and digest of a full re-read against those of the rows as they were written; up to three tries.

    The source is read once a try: its rows are counted on their way to the
    files.  Each try has a path of its own; the number of the good one is
    returned with its counts.
    """
    spark = df.sparkSession
    measures = (F.count("*").alias("rows"), row_digest(df.columns).alias("digest"))
    for attempt in range(TRIES):
        to, seen = f"{path}/try={attempt}", Observation()
        write_chunks(df.observe(seen, *measures), to, partition_by, iceberg)
        written = (seen.get["rows"], seen.get["digest"])
        found = spark.read.schema(df.schema).parquet(to).agg(*measures).first()
        if tuple(found) == written:
            return {"attempt": attempt, "rows": written[0]}
    raise VerificationFailed(f"{path}: {written[0]} rows were written, {found[0]} are there, or others")


@contextmanager
def _files_packed(spark: SparkSession, target: int) -> Iterator[None]:
    """Whole files are packed into tasks of ``target`` bytes, however few tasks that makes."""
    own = {"spark.sql.files.maxPartitionBytes": str(target), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def merge_files(spark: SparkSession, paths: list[str], to: str, target_bytes: int = MAX_FILE_BYTES, iceberg: bool = False) -> None:
    """SNK8: existing files rewritten into files of about ``target_bytes``, one a task.

    Small files are packed into the reading tasks, so nothing is shuffled and
    rows keep the order they have in their file; a larger file is cut at its row groups.
    """
    with _files_packed(spark, target_bytes):
        spark.read.option("recursiveFileLookup", "true").parquet(*paths).write.option("compression", "zstd" if iceberg else "gzip").parquet(to)


def identified(df: DataFrame) -> DataFrame:
    """SNK9: rows with file_id and row_number, stored with them: they stay when files are merged."""
    return df.withColumn("file_id", F.concat_ws("-", F.lit(uuid.uuid4().hex), F.spark_partition_id())).withColumn("row_number", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))


def with_row_identity(spark: SparkSession, path: str) -> DataFrame:
    """SNK9: rows with file_id (its path: one task gives its files in several folders one name) and row_number of their place."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file_id"), F.col("_metadata.row_index").alias("row_number"))


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """AGG17: stored identities (:func:`identified`) that occur more than once: rows that were written or merged twice."""
    others = [F.first(F.col(f"`{c}`")).alias(c) for c in rows.columns if c not in ("file_id", "row_number")]
    return rows.groupBy("file_id", "row_number").agg(F.count("*").alias("count"), *others).where("count > 1")


def ingest_metrics(blobs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG18: count, mean and percentiles of latencies (ms), throughput and sizes of files
    (build_ms, upload_ms, register_ms, flush_ms, bytes, row_count).

    Percentiles are exact: the least latency that so many of all files do not
    exceed.  They are taken from counts of the distinct milliseconds.
    """
    stages = [c for c in ("build_ms", "upload_ms", "register_ms", "flush_ms") if c in blobs.columns]
    measures = [F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("row_count").alias("rows")]
    for c in stages:
        measures += [F.avg(c).alias(f"{c}_mean"), *(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{c}`)").cast(blobs.schema[c].dataType).alias(f"{c}_p{round(100 * p)}") for p in (0.5, 0.95, 0.99))]
    if "upload_ms" in stages:
        measures.append(((F.sum("bytes").cast("decimal(38,0)") * 1000).cast("double") / F.sum("upload_ms")).alias("bytes_per_second"))
    return blobs.groupBy(*(by or [])).agg(*measures)
