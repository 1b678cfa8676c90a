"""Channels: offset continuity, state, commit checks, fencing and replay.

Batches are rows (channel, batch_seq, start_token, end_token, row_count);
tokens are opaque strings, null where none was given.  What depends on the order
inside a channel is scanned by ranges (``scans``), so a channel with a
third of all rows is read by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadstone.operators.scans import scan

Verification = Callable[[Column, Column, Column, Column], Column]


def default_verification(previous: Column, start: Column, end: Column, rows: Column) -> Column:
    """WIN2: ``end - start + 1 = rows`` and ``start = previous + 1``; what is not a number, or not given, is not checked."""
    p, s, e = (c.try_cast("bigint") for c in (previous, start, end))
    return F.coalesce(e - s + 1 == rows, F.lit(True)) & F.coalesce(s == p + 1, F.lit(True))


def verify_offsets(batches: DataFrame, verify: Verification = default_verification, channel: str = "channel", order: str = "batch_seq") -> DataFrame:
    """WIN1, UDF1: adds previous_token and offset_ok.  Mismatches are reported, never rejected.

    ``row_count`` counts bad rows too where they are skipped one by one; batches
    whose ``status`` is skipped or aborted are neither checked nor predecessors.
    """
    if "status" in batches.columns:
        out = verify_offsets(batches.where("status = 'loaded'").drop("status"), verify, channel, order).withColumn("status", F.lit("loaded"))
        return out.unionByName(batches.where("status <> 'loaded'"), allowMissingColumns=True)
    batches = scan(batches, [channel], [order], {"previous_token": ("before", F.col("end_token"))})
    ok = verify(F.col("previous_token"), F.col("start_token"), F.col("end_token"), F.col("row_count"))
    return batches.withColumn("offset_ok", ok)


def channel_latest(batches: DataFrame, channel: str = "channel", order: str = "batch_seq", flushed: DataFrame | None = None) -> DataFrame:
    """WIN3: last end token, row sequencer, and start token of the first batch since the last flush.

    ``flushed`` (channel, ``order``) tells the last batch of each channel that was
    flushed; without it nothing was.  The start token is null if no batch followed.
    """
    batches = batches.withColumn("_mark", F.lit(None).cast(batches.schema[order].dataType))
    if flushed is not None:
        batches = batches.drop("_mark").join(flushed.select(channel, F.col(order).alias("_mark")), channel, "left")
    new = F.col("_mark").isNull() | (F.col(order) > F.col("_mark"))
    return batches.groupBy(channel).agg(
        F.min_by(F.when(new, F.col("start_token")), F.when(new, F.col(order))).alias("start_token"), F.max_by("end_token", order).alias("end_token"), F.max(order).alias("last_batch"),
        F.count("*").alias("row_sequencer"), F.sum("row_count").alias("rows_inserted"),
    )


def sequencer_gaps(flushes: DataFrame, channel: str = "channel", sequencer: str = "row_sequencer", order: str | None = None) -> DataFrame:
    """WIN4: adds ``in_sequence`` and ``valid``; the first flush that is not its
    predecessor's successor invalidates the channel from there on."""
    order = order or sequencer
    out = scan(flushes, [channel], [order], {"_before": ("before", F.col(sequencer))})
    out = out.withColumn("in_sequence", F.coalesce(F.col(sequencer) == F.col("_before") + 1, F.lit(True))).drop("_before")
    out = scan(out, [channel], [order], {"_unbroken": ("min", F.col("in_sequence").cast("int"))}, peers=True)
    return out.withColumn("valid", F.col("_unbroken") == 1).drop("_unbroken")


def committed_offsets(channels: DataFrame, state: DataFrame) -> DataFrame:
    """JOIN2: the persisted token of each channel asked for; null if it has none."""
    return channels.join(state.select("channel", F.col("end_token").alias("committed_token")), "channel", "left")


def uncommitted_channels(local: DataFrame, state: DataFrame) -> DataFrame:
    """JOIN3: channels whose persisted sequencer is not the local one, and those in error."""
    persisted = state.select("channel", F.col("row_sequencer").alias("persisted_sequencer"), "status_code")
    joined = local.select("channel", F.col("row_sequencer").alias("local_sequencer")).join(persisted, "channel", "left")
    behind = ~F.col("local_sequencer").eqNullSafe(F.col("persisted_sequencer")) | (F.coalesce("status_code", F.lit(0)) != 0)
    return joined.where(behind)


def matching_writers(requests: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JOIN4: (requests that name the current client sequencer, the others)."""
    key = ["channel", "client_sequencer"]
    return requests.join(state.select(*key), key, "left_semi"), requests.join(state.select(*key), key, "left_anti")


def accepted_batches(batches: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """STR7: (batches of valid channels, the others with code 0013: invalid, or 0014: not open)."""
    joined = batches.join(state.select("channel", F.col("valid").alias("_valid")), "channel", "left")
    ok = F.coalesce("_valid", F.lit(False))
    code = F.when(F.col("_valid").isNull(), "0014").otherwise("0013")
    return joined.where(ok).drop("_valid"), joined.where(~ok).withColumn("code", code).drop("_valid")


def retry_chunks(chunks: DataFrame, rejected: DataFrame) -> DataFrame:
    """JOIN1: chunks with any channel among the rejected (channel, client_sequencer)."""
    hit = chunks.select("chunk_id", F.explode("channels").alias("c")).select("chunk_id", "c.channel", "c.client_sequencer")
    hit = hit.join(rejected.select("channel", "client_sequencer"), ["channel", "client_sequencer"], "left_semi").select("chunk_id").distinct()
    return chunks.join(hit, "chunk_id", "left_semi")


def pending_files(requested: DataFrame, history: DataFrame) -> DataFrame:
    """JOIN5: requested files without a complete history entry."""
    return requested.join(history.where("complete").select("path"), "path", "left_anti")


def fenced(rows: DataFrame, channel: str = "channel", order: str = "batch_seq", sequencer: str = "client_sequencer") -> DataFrame:
    """STR6: adds ``accepted``: the writer is the newest seen so far in the log of its channel."""
    out = scan(rows, [channel], [order], {"_newest": ("max", F.col(sequencer))}, peers=True)
    return out.withColumn("accepted", F.col(sequencer) == F.col("_newest")).drop("_newest")


def mismatch_events(verified: DataFrame, channel: str = "channel", at: str = "ts") -> DataFrame:
    """STR12: mismatches, at most one per channel and second."""
    w = Window.partitionBy(channel, F.date_trunc("second", at)).orderBy(at)
    return verified.where(~F.col("offset_ok")).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
