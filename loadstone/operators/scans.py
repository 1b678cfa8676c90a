"""Ordered scans that no key holds up: the row before, running sums, maxima and minima.

A plain window reads all rows of a key in one task.  Here the rows are sorted into
ranges of (keys, order), so a key with a third of all rows lies in a third of the
ranges; each range is scanned by itself, and what the ranges before it end with is
carried into it: one row for each range and key.

The ranges are written to the shared folder once: both steps, and a task that runs
again after its executor is lost, read the same ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadstone.sources.files import new_folder

KINDS = ("before", "sum", "max", "min")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder; lineage ends here."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def scan(df: DataFrame, keys: list[str], order: list[str], measures: dict[str, tuple[str, Column]], peers: bool = False, ranges: int | None = None) -> DataFrame:
    """Adds ``measures``, name: (kind, value), to the rows of ``df``.

    ``before`` is the value of the row before, in ``order`` (ascending, nulls
    first), among rows with the same ``keys``; null for the first.  ``sum``,
    ``max`` and ``min`` are of the values up to this row; with ``peers`` rows of
    equal order have the same.  Null keys are a key.  Rows of equal keys and order lie
    in one range and are taken in any order.  The number of ``ranges`` is twice that of shuffle
    partitions unless given.
    """
    if any(kind not in KINDS for kind, _ in measures.values()):
        raise ValueError(f"a measure is one of {KINDS}")
    n = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = {f"_value_{k}": value for k, (_, value) in enumerate(measures.values())}
    marked = df.withColumns(values).repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id())
    rows = stored(marked, "ranges")

    local = Window.partitionBy("_range", *keys).orderBy(*order)
    upto = local.rangeBetween(Window.unboundedPreceding, 0) if peers else local.rowsBetween(Window.unboundedPreceding, 0)
    over = Window.partitionBy(*keys).orderBy("_range")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(*order)
    inside, ends, carries, combined = {"_first": F.row_number().over(local) == 1}, [], {}, {}
    for k, (name, (kind, _)) in enumerate(measures.items()):
        value, carry = F.col(f"_value_{k}"), F.col(f"_carry_{k}")
        if kind == "before":
            inside[f"_local_{k}"] = F.lag(value).over(local)
            ends.append(F.max_by(F.struct(value), at).alias(f"_end_{k}"))
            carries[f"_carry_{k}"] = F.lag(f"_end_{k}").over(over)[f"_value_{k}"]
            combined[name] = F.when(F.col("_first"), carry).otherwise(F.col(f"_local_{k}"))
            continue
        fold = {"sum": F.sum, "max": F.max, "min": F.min}[kind]
        inside[f"_local_{k}"] = fold(value).over(upto)
        ends.append(fold(value).alias(f"_end_{k}"))
        carries[f"_carry_{k}"] = fold(F.col(f"_end_{k}")).over(earlier)
        both = {"sum": lambda a, b: F.coalesce(a + b, a, b), "max": F.greatest, "min": F.least}[kind]
        combined[name] = both(F.col(f"_local_{k}"), carry)
    carried = rows.groupBy("_range", *keys).agg(*ends).withColumns(carries)
    carried = carried.select(F.col("_range").alias("_of"), *(F.col(c).alias(f"_key_{i}") for i, c in enumerate(keys)), *carries)
    match = reduce(Column.__and__, (_same(F.col(c), F.col(f"_key_{i}")) for i, c in enumerate(keys)), F.col("_range") == F.col("_of"))
    out = rows.withColumns(inside).join(carried, match).withColumns(combined)
    return out.select(*df.columns, *measures)
