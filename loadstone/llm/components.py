"""Connected components of a link table, as Spark jobs.

Alternating star contraction: the *large star* step links every node's larger
neighbours to its smallest neighbour, the *small star* step links the smaller
ones.  Each step is one grouped minimum (partial per task, so a hub of many
links is pre-aggregated) and one join; the number of rounds grows with the
logarithm of the component size.  Links stay in tables; only the number of
changed links comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm._io import Scratch


def components(links: DataFrame, rounds: int = 40, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the least node of
    its component.  Loops and repeated links are ignored; nulls are dropped.
    Links that still change after ``rounds`` are an error.  The tables of the
    rounds are of ``scratch``, which the caller clears when it has stored the
    result; the last of them stays if there is none."""
    rounds_scratch = Scratch(links.sparkSession)
    edges = links.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, told = _written(edges, links.count(), rounds_scratch)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v")
        before = told
        done, rounds_scratch = rounds_scratch, Scratch(links.sparkSession)
        edges, told = _written(small.distinct(), before[0], rounds_scratch)
        done.clear()  # the new table has been written: nothing reads the old one
        if told == before:
            break
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    if scratch is not None:
        scratch.paths += rounds_scratch.paths
    tops = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return tops.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))


def _written(edges: DataFrame, about: int, scratch: Scratch) -> tuple[DataFrame, tuple[int, int]]:
    """The edges as a stored table of files of fair size, and what tells one set
    of edges from another: its number and the sum of its hashes."""
    edges = scratch.stored(edges.coalesce(4 + about // 500_000), "edges")
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return edges, (row[0], int(row[1] or 0))
