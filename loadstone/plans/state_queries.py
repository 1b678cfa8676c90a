"""Registered queries of channel state: committed offsets, writers, mismatches, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadstone.operators import offsets
from loadstone.plans.registry import query, read
from loadstone.plans.schema import table_schema
from loadstone.sources import files
from loadstone.streaming import stream

_CHANNELS = "WITH c AS (SELECT user_id AS channel, max(event_id)::VARCHAR AS token, count(*) AS n FROM events GROUP BY user_id)"


@query(f"{_CHANNELS} SELECT channel, CASE WHEN channel % 6 <> 0 THEN token END AS committed_token FROM c")
def committed_offsets(spark, sf_dir):
    """JOIN2: the persisted token of each channel; null if it has none"""
    e = read(spark, sf_dir, "events")
    asked = e.select(F.col("user_id").alias("channel")).distinct()
    state = e.where("user_id % 6 <> 0").groupBy(F.col("user_id").alias("channel")).agg(F.max("event_id").cast("string").alias("end_token"))
    return offsets.committed_offsets(asked, state)


@query("SELECT event_id, CASE WHEN event_id % 3 = user_id % 3 THEN 'current' ELSE 'superseded' END AS writer FROM events")
def matching_writers(spark, sf_dir):
    """JOIN4: requests that name the current client sequencer of their channel, and the others"""
    e = read(spark, sf_dir, "events")
    asked = e.select("event_id", F.col("user_id").alias("channel"), (F.col("event_id") % 3).alias("client_sequencer"))
    state = e.select(F.col("user_id").alias("channel"), (F.col("user_id") % 3).alias("client_sequencer")).distinct()
    current, old = offsets.matching_writers(asked, state)
    return current.select("event_id", F.lit("current").alias("writer")).union(old.select("event_id", F.lit("superseded")))


@query("""SELECT event_id // 100 AS batch_seq, user_id AS channel, CASE WHEN user_id % 9 = 0 THEN '0014' WHEN user_id % 4 = 0 THEN '0013' END AS code, count(*) AS row_count FROM events GROUP BY ALL""")
def accepted_batches(spark, sf_dir):
    """STR7: batches of channels that are invalid or not open are rejected, each with its code"""
    e = read(spark, sf_dir, "events")
    batches = e.groupBy(F.floor(F.col("event_id") / 100).alias("batch_seq"), F.col("user_id").alias("channel")).agg(F.count("*").alias("row_count"))
    state = e.where("user_id % 9 <> 0").select(F.col("user_id").alias("channel"), (F.col("user_id") % 4 != 0).alias("valid")).distinct()
    accepted, rejected = offsets.accepted_batches(batches, state)
    return accepted.withColumn("code", F.lit(None).cast("string")).unionByName(rejected).select("batch_seq", "channel", "code", "row_count")


@query("""WITH e AS (SELECT event_type, value > 300 AS bad FROM events)
  SELECT event_type AS "table", count(*) FILTER (WHERE event_type IN ('click', 'view') AND NOT bad) AS good, count(*) FILTER (WHERE event_type = 'click' AND bad OR event_type = 'view' AND bad) AS errors, count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS unknown FROM e GROUP BY ALL""")
def stream_many_tables(spark, sf_dir):
    """STR15: rows of many tables in one stream, two of them with a schema"""
    path = files.new_folder(spark, "tables")
    source = read(spark, sf_dir, "events")
    source.write.parquet(f"{path}/in")
    value = {"name": "VALUE", "logicalType": "FIXED", "physicalType": "SB16", "precision": 38, "scale": 2}
    schemas = {"click": table_schema([value, {"name": "PROPS", "logicalType": "VARIANT"}]), "view": table_schema([value, {"name": "PROPS", "logicalType": "TEXT"}])}

    def prepare(batch):
        number = F.when(F.col("value") > 300, F.lit("much")).otherwise(F.col("value").cast("decimal(20,4)").cast("string"))
        row = F.to_json(F.create_map(F.lit("value"), number, F.lit("props"), F.col("props")))
        return batch.select(F.col("event_type").alias("table"), F.lit("c").alias("channel"), F.floor(F.col("event_id") / 100).alias("batch_id"), F.col("event_id").alias("row_index"), row.alias("row_json"))

    writer = stream.row_stream(spark, f"{path}/in", source.schema).writeStream.foreachBatch(stream.load_tables(f"{path}/out", schemas, prepare=prepare))
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(**stream.trigger(available_now=True)).start().awaitTermination()
    count = lambda rows, kind: rows.groupBy("table").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
    told = count(spark.read.parquet(f"{path}/out/unknown"), "unknown")
    for table in schemas:
        told = told.union(count(stream.loaded(spark, f"{path}/out/{table}"), "good")).union(count(stream.loaded(spark, f"{path}/out/{table}", "errors"), "errors"))
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("good", "errors", "unknown")]
    return told.groupBy("table").agg(*sums)


@query("""WITH v AS (SELECT event_id, user_id % 5 AS channel, epoch_us(ts) AS us, event_id % 4 = 0 AS bad FROM events),
  r AS (SELECT *, row_number() OVER (PARTITION BY channel, us // 1000000 ORDER BY us, event_id) AS n FROM v WHERE bad)
  SELECT channel, us // 1000000 AS second, min(us) AS us FROM r WHERE n = 1 GROUP BY ALL""")
def mismatch_events(spark, sf_dir):
    """STR12: offset mismatches, at most one per channel and second"""
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    seen = read(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("channel"), utc.alias("ts"), (F.col("event_id") % 4 != 0).alias("offset_ok"))
    told = offsets.mismatch_events(seen)
    return told.select("channel", F.unix_seconds("ts").alias("second"), F.unix_micros("ts").alias("us"))


_BATCHES = """WITH b AS (SELECT (event_id // 2500)::VARCHAR AS channel, event_id // 100 AS batch_seq, count(*) AS n, CASE WHEN event_id // 100 % 25 = 20 THEN 0 WHEN event_id // 100 % 25 > 14 THEN 1 ELSE 0 END AS client,
    (event_id // 100) * 100 + CASE WHEN event_id // 100 % 7 = 3 THEN 5 ELSE 0 END AS start_token, (event_id // 100) * 100 + 99 AS end_token FROM events GROUP BY ALL),
  a AS (SELECT *, client = max(client) OVER (PARTITION BY channel ORDER BY batch_seq) AS accepted FROM b),
  k AS (SELECT *, lag(end_token) OVER (PARTITION BY channel ORDER BY batch_seq) AS before, row_number() OVER (PARTITION BY channel ORDER BY batch_seq) AS row_sequencer FROM a WHERE accepted)"""


@query(f"""{_BATCHES} SELECT channel, batch_seq, true AS accepted, end_token - start_token + 1 = n AND coalesce(start_token = before + 1, true) AS offset_ok, row_sequencer FROM k
  UNION ALL SELECT a.channel, a.batch_seq, false, NULL, (SELECT max(row_sequencer) FROM k WHERE k.channel = a.channel AND k.batch_seq < a.batch_seq) FROM a WHERE NOT accepted""")
def tracked_channels(spark, sf_dir):
    """STR13: continuity, sequencers and fencing of channels on a stream, with state per channel"""
    path = files.new_folder(spark, "tracked")
    seq = F.floor(F.col("event_id") / 100)
    client = F.when(seq % 25 == 20, 0).when(seq % 25 > 14, 1).otherwise(0).cast("long")
    b = read(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 2500).cast("string").alias("channel"), seq.alias("batch_seq")).agg(F.count("*").alias("row_count"), F.max(client).alias("client_sequencer"))
    late = F.when(F.col("batch_seq") % 7 == 3, 5).otherwise(0)
    b = b.select("channel", "batch_seq", "client_sequencer", (F.col("batch_seq") * 100 + late).cast("string").alias("start_token"), (F.col("batch_seq") * 100 + 99).cast("string").alias("end_token"), "row_count")
    b.write.parquet(f"{path}/in")

    def keep(rows, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    tracked = stream.track_channels(spark.readStream.schema(b.schema).parquet(f"{path}/in"))
    tracked.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{path}/checkpoint").trigger(**stream.trigger(available_now=True)).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").select("channel", "batch_seq", "accepted", "offset_ok", "row_sequencer")
