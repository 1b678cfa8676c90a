"""Continuous loading: triggers, exactly-once progress, channels over time.

A micro-batch is conformed and written under its batch number; the channel
state of the same number is written last and is the commit.  A batch number
that is already in the state is a replay and is left out.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loadstone.operators.conform import CONTINUE, Conformed, by_policy, checked_rows
from loadstone.operators.offsets import uncommitted_channels

LAG_DEFAULT, LAG_DEFAULT_ICEBERG, LAG_LEAST, LAG_MOST = 1.0, 30.0, 1.0, 600.0
CHANNEL_BYTES = 64 * 1024 * 1024


def max_client_lag(text: str | float | None = None, iceberg: bool = False) -> float:
    """STR1: seconds between flushes from ``2 minutes``, ``90`` (seconds) or nothing; 1 s to 10 min."""
    if text is None:
        return LAG_DEFAULT_ICEBERG if iceberg else LAG_DEFAULT
    m = re.fullmatch(r"(\d+)(?:\s+(seconds?|minutes?))?", str(text).strip().lower())
    if not m:
        raise ValueError(f"not a lag: {text!r}")
    seconds = float(m[1]) * (60 if (m[2] or "").startswith("minute") else 1)
    if not LAG_LEAST <= seconds <= LAG_MOST:
        raise ValueError(f"lag of {seconds:g} s is outside {LAG_LEAST:g} to {LAG_MOST:g} s")
    return seconds


def trigger(lag: str | float | None = None, available_now: bool = False, iceberg: bool = False) -> dict:
    """STR1, STR3: arguments of ``writeStream.trigger``."""
    return {"availableNow": True} if available_now else {"processingTime": f"{max_client_lag(lag, iceberg):g} seconds"}


def row_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, max_bytes: int | None = CHANNEL_BYTES) -> DataFrame:
    """SRC6, STR2, STR14: rows of files as they arrive, at most so many bytes or files a trigger."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def csv_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """STR14: CSV files of a pipe as they arrive, in any folder below; the source keeps the log of those it has seen."""
    return spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").csv(path)


def is_committed(spark: SparkSession, path: str, number: int) -> bool:
    """Whether the state of a batch is there: one look at its own folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state/stream_batch_dir={number}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_batch(path: str, schema, on_error: str | DataFrame = CONTINUE, prepare: Callable[[DataFrame], DataFrame] | None = None, zone: str = "America/Los_Angeles") -> Callable[[DataFrame, int], None]:
    """STR4, STR15: a ``foreachBatch`` function: data, errors and report under the batch number, then the state.

    A batch is checked once and stored; its three outputs are read from that.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, path, number):
            return
        folder = lambda name: f"{path}/{name}/stream_batch_dir={number}"
        rows = checked_rows(prepare(batch) if prepare else batch, schema, zone)
        rows.write.mode("overwrite").parquet(folder("checked"))
        result: Conformed = by_policy(spark.read.schema(rows.schema).parquet(folder("checked")), schema, on_error)
        for name, frame in (("data", result.good), ("errors", result.errors), ("report", result.report)):
            frame.withColumn("stream_batch", F.lit(number)).write.mode("overwrite").parquet(folder(name))
        report = spark.read.parquet(folder("report"))
        state = report.groupBy("table", "channel").agg(F.max("batch_id").alias("last_batch"), F.sum("loaded_rows").alias("loaded_rows"), F.sum("error_rows").alias("error_rows"))
        state.withColumn("stream_batch", F.lit(number)).coalesce(1).write.mode("overwrite").parquet(folder("state"))

    return write


def load_tables(path: str, schemas: dict, on_error: str | DataFrame = CONTINUE, prepare: Callable[[DataFrame], DataFrame] | None = None, zone: str = "America/Los_Angeles") -> Callable[[DataFrame, int], None]:
    """STR15: a ``foreachBatch`` function for many tables in one stream: each has a folder and a schema of its own.

    Rows of tables without a schema are kept as they came, under ``unknown``.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = (prepare(batch) if prepare else batch).persist()
        try:
            for table, schema in schemas.items():
                load_batch(f"{path}/{table}", schema, on_error, zone=zone)(rows.where(F.col("table") == table), number)
            other = rows.where(~F.coalesce(F.col("table").isin(*schemas), F.lit(False)))
            other.write.mode("overwrite").parquet(f"{path}/unknown/stream_batch_dir={number}")
        finally:
            rows.unpersist()

    return write


def loaded(spark: SparkSession, path: str, part: str = "data") -> DataFrame:
    """Rows of committed batches only."""
    done = spark.read.parquet(f"{path}/state").select("stream_batch").distinct()
    return spark.read.parquet(f"{path}/{part}").join(done, "stream_batch", "left_semi").drop("stream_batch", "stream_batch_dir")


# --- channels -----------------------------------------------------------------------

STATE = "channel string, client_sequencer long, row_sequencer long, end_token string, valid boolean, status_code int"


def open_channel(state: DataFrame, channel: str, token: str | None = None) -> DataFrame:
    """STR5: the state with the channel's client sequencer one higher; its token kept unless one is given."""
    spark = state.sparkSession
    new = spark.createDataFrame([(channel, token)], "channel string, _token string")
    old = state.join(new, "channel", "left_semi")
    opened = new.join(old, "channel", "left").select(
        "channel", (F.coalesce("client_sequencer", F.lit(-1)) + 1).alias("client_sequencer"), F.coalesce("row_sequencer", F.lit(0)).alias("row_sequencer"),
        F.coalesce("_token", "end_token").alias("end_token"), F.lit(True).alias("valid"), F.lit(0).alias("status_code"),
    )
    return state.join(new, "channel", "left_anti").select(opened.columns).unionByName(opened)


def drop_channel(state: DataFrame, channel: str, client_sequencer: int | None = None) -> DataFrame:
    """STR9: the state without the channel, if the sequencer is the current one."""
    hit = F.col("channel") == channel
    if client_sequencer is not None:
        hit &= F.col("client_sequencer") == client_sequencer
    return state.where(~hit)


class NotCommitted(RuntimeError):
    """STR8: channels that a close found uncommitted (code 0025); ``channels`` is the frame of all of them."""

    def __init__(self, message: str, channels: DataFrame):
        super().__init__(message)
        self.channels = channels


def close_channels(local: DataFrame, state: DataFrame) -> None:
    """STR8: fails if rows of channels are not all committed; names the first in the message, and all in ``channels``."""
    behind = uncommitted_channels(local, state)
    if n := behind.count():
        first = [r["channel"] for r in behind.orderBy("channel").limit(20).collect()]
        raise NotCommitted(f"0025: {n} channels not committed: {', '.join(first)}{', ...' if n > 20 else ''}", behind)


class ChannelTracker(StatefulProcessor):
    """STR13: continuity, sequencers and fencing of each channel on an unbounded stream.

    In: channel, batch_seq, client_sequencer, start_token, end_token, row_count.
    Out: channel, batch_seq, accepted, offset_ok, row_sequencer, end_token.
    """

    OUTPUT = "channel string, batch_seq long, accepted boolean, offset_ok boolean, row_sequencer long, end_token string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("channel", "client_sequencer long, row_sequencer long, end_token string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        client, sequencer, token = self.state.get() if self.state.exists() else (-1, 0, None)
        out = []
        for row in sorted((r for part in rows for r in part.itertuples(index=False)), key=lambda r: r.batch_seq):
            accepted = row.client_sequencer >= client
            ok = None
            if accepted:
                client = int(row.client_sequencer)
                ok = _continues(token, row.start_token, row.end_token, row.row_count)
                token, sequencer = row.end_token, sequencer + 1
            out.append((key[0], int(row.batch_seq), accepted, ok, sequencer, token))
        self.state.update((client, sequencer, token))
        yield pd.DataFrame(out, columns=["channel", "batch_seq", "accepted", "offset_ok", "row_sequencer", "end_token"])

    def close(self) -> None:
        pass


def _continues(previous, start, end, rows) -> bool:
    number = lambda t: int(t) if isinstance(t, str) and re.fullmatch(r"[+-]?\d+", t) else None
    p, s, e = number(previous), number(start), number(end)
    return (s is None or e is None or e - s + 1 == rows) and (p is None or s is None or s == p + 1)


def track_channels(batches: DataFrame) -> DataFrame:
    """STR13: the tracker over a stream; sets the state store that it needs, and sends the tracker to its workers by value."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    batches.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return batches.groupBy("channel").transformWithStateInPandas(statefulProcessor=ChannelTracker(), outputStructType=ChannelTracker.OUTPUT, outputMode="Update", timeMode="None")
