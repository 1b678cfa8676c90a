"""Shared-folder helpers of the training-data operators.

Intermediate tables that several steps read are written as Parquet to the
folder in ``spark.checkpoint.dir``: every executor sees it, so a lost executor
costs only the tasks it was running.  The setting is read from the session.
Where it is unset a temporary folder takes its place if Spark runs in this
process alone (tests, a laptop); on a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    for conf in (spark.conf, spark.sparkContext.getConf()):
        found = conf.get("spark.checkpoint.dir", None)
        if found:
            return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="loadstone-shared-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables that are deleted together, once nothing that is still to be computed reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.paths = []


BUCKET_BYTES = 32 << 20  # of stored input to one packed bucket


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files below ``df`` as the planner estimates them; None if it cannot tell."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 55 else None


def n_buckets(df: DataFrame) -> int:
    """Buckets for packed hash partitioning of ``df``: one for ``BUCKET_BYTES``
    of input, so what one group holds does not grow with the data; two for each
    shuffle partition at least."""
    least = max(64, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-(input_bytes(df) or 0) // BUCKET_BYTES))
