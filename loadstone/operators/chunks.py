"""Chunks and files: size-bounded packing of channel flushes, and their contents.

Packing is greedy and in order: where a chunk starts depends on where the one before
ended.  It is done as jumps.  Prefix sums tell for every flush where the next
chunk would start if one started here; a path of such jumps from the first flush has all
starts.  Flushes lie in blocks by their place, and one fold over a block tells
where a path that enters it at any flush leaves it.  Paths over blocks are
then doubled: after n rounds the first 2^n blocks of the path are known.  Only
places that a jump from an earlier block can reach take part in that.  No table,
however large, is packed in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadstone.operators.scans import scan, stored

MAX_CHUNK_BYTES = 256 * 1024 * 1024
MAX_BLOB_BYTES = 1024 * 1024 * 1024
MAX_CHUNKS_IN_BLOB = 100
BLOCK = 4096  # flushes of one fold


def next_starts(flushes: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Adds ``next_place`` to flushes (``keys``, place, upto, bytes): the first later
    place at which the bytes from this flush on exceed ``limit``; null if none.

    ``upto`` are the bytes up to and with a flush.  A range search by one scan:
    flushes and what is looked for are sorted together, largest first, and each
    question takes the least place seen above it.
    """
    above = F.col("upto") - F.col("bytes") + F.lit(limit)
    asked = flushes.select(*keys, (-above).alias("at"), F.lit(0).alias("kind"), "place", F.lit(None).cast("long").alias("found"))
    there = flushes.select(*keys, (-F.col("upto")).alias("at"), F.lit(1).alias("kind"), "place", F.col("place").alias("found"))
    seen = scan(asked.union(there), keys, ["at", "kind"], {"next_place": ("min", F.col("found"))}, peers=True)
    # a flush larger than the limit is a chunk of its own, so the next starts right after it
    return seen.where("kind = 0").select(*keys, "place", F.when(F.col("next_place").isNotNull(), F.greatest("next_place", F.col("place") + 1)).alias("next_place"))


def reached_places(jumps: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """The places (``keys``, place) on the path of ``jumps`` (``keys``, place,
    next_place) from place 0; places count from 0 without a gap."""
    blocks = jumps.withColumn("block", F.expr(f"place div {block}")).groupBy(*keys, "block").agg(F.array_sort(F.collect_list(F.struct("place", "next_place"))).alias("jumps"))
    blocks = stored(blocks, "blocks")

    # from the last flush of a block to its first: where a path leaves the block; the fold holds those after the flush
    leaves = F.aggregate(
        F.reverse("jumps"), F.array().cast("array<struct<place: bigint, way_out: bigint>>"),
        lambda seen, x: F.concat(F.array(F.struct(x["place"].alias("place"), F.coalesce(F.try_element_at(seen, (x["next_place"] - x["place"]).cast("int"))["way_out"], F.when(x["next_place"].isNull(), F.lit(-1).cast("long")).otherwise(x["next_place"])).alias("way_out"))), seen),
    )
    ways = stored(blocks.select(*keys, F.explode(leaves).alias("w")).select(*keys, "w.place", "w.way_out"), "ways")
    entries = jumps.where(F.expr(f"next_place div {block} > place div {block}")).select(*keys, F.col("next_place").alias("place")).distinct()
    first = ways.where("place = 0").select(*keys, "place", "way_out")
    doubled = stored(ways.join(entries, [*keys, "place"], "left_semi").where("way_out >= 0").union(first.where("way_out >= 0")), "doubled")
    reached = stored(first.select(*keys, "place"), "reached")
    while True:
        ahead = doubled.select(*keys, F.col("place").alias("_from"), F.col("way_out").alias("_to"))
        more = reached.withColumnRenamed("place", "_from").join(ahead, [*keys, "_from"]).select(*keys, F.col("_to").alias("place"))
        more = stored(more, "more")
        if more.isEmpty():
            break
        reached = reached.union(more)
        onward = doubled.select(*keys, F.col("place").alias("_to"), F.col("way_out").alias("_end"))
        doubled = stored(ahead.join(onward, [*keys, "_to"]).select(*keys, F.col("_from").alias("place"), F.col("_end").alias("way_out")), "doubled")

    # a path enters a block once at most; inside it the fold follows the jumps
    entered = reached.select(*keys, F.expr(f"place div {block}").alias("block"), F.col("place").alias("entry"))
    walk = F.aggregate(
        "jumps", F.struct(F.col("entry").alias("at"), F.array().cast("array<bigint>").alias("on")),
        lambda s, x: F.when(x["place"] == s["at"], F.struct(x["next_place"].alias("at"), F.concat(s["on"], F.array(x["place"])).alias("on"))).otherwise(s),
        lambda s: s["on"],
    )
    return blocks.join(entered, [*keys, "block"]).select(*keys, F.explode(walk).alias("place"))


def pack_chunks(flushes: DataFrame, max_chunk: int = MAX_CHUNK_BYTES, max_blob: int = MAX_BLOB_BYTES, order: str = "flush_seq", block: int = BLOCK) -> DataFrame:
    """WIN5: adds chunk_no and blob_no to flushes (table, ``order``, bytes[, column_set][, key_id]).

    The first flush of a chunk is never refused; the next closes it, and its
    file, if it would exceed a limit or has other columns or another key.  Flushes of
    equal table and ``order`` are taken by size; bytes are not negative.
    """
    extra = [c for c in ("column_set", "key_id") if c in flushes.columns]
    # the tags are read twice, by the packing and by the join at its end
    tagged = stored(flushes.withColumn("_tag", F.monotonically_increasing_id()), "flushes")
    # a null table is a table of its own
    slim = tagged.select(F.to_json(F.struct("table")).alias("table_key"), F.col(order).alias("seq"), F.col("bytes").cast("long").alias("bytes"), F.col("_tag").alias("tag"), F.struct(F.lit(0).alias("none"), *extra).alias("own"))
    by, run = ["seq", "bytes", "tag"], F.lit(0).cast("long")
    if extra:
        slim = scan(slim, ["table_key"], by, {"last": ("before", F.col("own"))})
        slim = scan(slim, ["table_key"], by, {"run": ("sum", (F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("own"))).cast("long"))})
        run = F.col("run")
    slim = slim.select("table_key", run.alias("run"), *by)
    keys = ["table_key", "run"]
    placed = scan(slim, keys, by, {"place": ("sum", F.lit(1).cast("long")), "upto": ("sum", F.col("bytes"))})
    placed = stored(placed.withColumn("place", F.col("place") - 1), "placed")
    jumps = stored(next_starts(placed, keys, min(max_chunk, max_blob)), "jumps")
    starts = reached_places(jumps, keys, block).withColumn("start", F.lit(1).cast("long"))
    marked = placed.join(starts, [*keys, "place"], "left")
    numbered = scan(marked, ["table_key"], by, {"chunks": ("sum", F.coalesce("start", F.lit(0).cast("long")))})
    number = F.col("chunks") - 1
    return tagged.join(numbered.select(F.col("tag").alias("_tag"), number.alias("chunk_no"), number.alias("blob_no")), "_tag").drop("_tag")


def blobs_of_chunks(chunks: DataFrame, order: str, by: list[str], most: int = MAX_CHUNKS_IN_BLOB) -> DataFrame:
    """WIN6: adds blob_no: at most ``most`` chunks to a file, in order, in each group of ``by`` (tables, or days of one)."""
    if not by:
        raise ValueError("name the columns that keep files apart")
    w = Window.partitionBy(*by).orderBy(order)
    return chunks.withColumn("blob_no", F.floor((F.row_number().over(w) - 1) / most))


def chunk_totals(flushes: DataFrame) -> DataFrame:
    """AGG12, AGG16: rows, bytes and insert-time range of each chunk."""
    return flushes.groupBy("table", "chunk_no").agg(
        F.sum("row_count").alias("row_count"), F.sum("bytes").alias("bytes"), F.count("*").alias("flushes"),
        F.min("first_insert").alias("first_insert"), F.max("last_insert").alias("last_insert"),
    )


class MixedTables(ValueError):
    """Rows of more than one table in a chunk."""


def concatenate(*channels: DataFrame, evolved: bool = False) -> DataFrame:
    """SET1, SET2: the rows of channels of one table; ``evolved`` fills columns that some lack."""
    out = channels[0]
    for c in channels[1:]:
        out = out.unionByName(c, allowMissingColumns=evolved)
    if "table" in out.columns:
        tables = [r["table"] for r in out.select("table").distinct().limit(2).collect()]
        if len(tables) > 1:
            raise MixedTables(f"one chunk cannot hold tables {sorted(map(str, tables))}")
    return out
