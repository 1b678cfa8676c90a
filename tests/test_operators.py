"""Rows, policies, statistics, channels, chunks, sinks, files and streams."""

import hashlib
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadstone.operators import chunks, offsets, scans, stats
from loadstone.operators.conform import BatchAborted, conform, unquote_name
from loadstone.plans.schema import iceberg_type, missing_required, table_schema
from loadstone.sources import csv_lines, files, sink
from loadstone.streaming import stream

RAW = "table string, channel string, batch_id long, row_index long, row_json string"


def raw(spark, rows, channel="c"):
    return spark.createDataFrame([("t", channel, b, i, json.dumps(r)) for b, i, r in rows], RAW)


ONE = [{"name": "c1", "logicalType": "FIXED", "physicalType": "SB4", "precision": 9, "scale": 0}]


def batches(*parts):
    return [(b, i, {"c1": v}) for b, values in enumerate(parts) for i, v in enumerate(values)]


def values(result):
    return sorted(int(r.C1) for r in result.good.collect())


def test_continue(spark):
    got = conform(raw(spark, batches([1], [1, 2, "a"])), table_schema(ONE))
    assert values(got) == [1, 1, 2]
    assert [(r.batch_id, r.row_index, r.code) for r in got.errors.collect()] == [(1, 2, "0030")]
    assert {r.batch_id: (r.row_count, r.error_rows, r.status) for r in got.report.collect()} == {0: (1, 0, "loaded"), 1: (3, 1, "loaded")}


def test_abort(spark):
    rows = raw(spark, batches([1], [2], ["a"], [1, 2, "a"], [7]))
    got = conform(rows, table_schema(ONE), "abort")
    assert values(got) == [1, 2, 7]
    assert {(r.batch_id, r.row_index) for r in got.errors.collect()} == {(2, 0), (3, 2)}
    with pytest.raises(BatchAborted):
        conform(rows, table_schema(ONE), "abort", raise_on_abort=True)


def test_skip_batch(spark):
    got = conform(raw(spark, batches([1], [1, "b", "a"], [4])), table_schema(ONE), "skip_batch")
    assert values(got) == [1, 4]
    assert got.errors.count() == 2


def test_policy_by_channel(spark):
    rows = raw(spark, batches([1, "a"]), "x").union(raw(spark, batches([2, "a"]), "y"))
    policies = spark.createDataFrame([("t", "y", "SKIP_BATCH")], "table string, channel string, on_error string")
    assert values(conform(rows, table_schema(ONE), policies)) == [1]


def test_check_order_and_names(spark):
    schema = table_schema([*ONE, {"name": '"low"', "logicalType": "TEXT", "length": 3, "nullable": False}])
    rows = [{"c1": "x", "zz": 1}, {"c1": "x"}, {"c1": "x", '"low"': None}, {"C1": "x", '"low"': "abcd"}, {"c1": 5, '"low"': "abc"}]
    got = {r.row_index: r for r in conform(raw(spark, [(0, i, r) for i, r in enumerate(rows)]), schema).errors.collect()}
    assert got[0].extra_columns == ["zz"] and got[1].missing_not_null == ['"low"'] and got[2].null_not_null == ['"low"']
    assert "c1" in got[3].message and "low" in got[3].message and 4 not in got
    big = conform(raw(spark, [(0, 0, {"c1": 1, '"low"': "abc"})]), schema, max_row_bytes=5).errors.first()
    assert big.code == "0031"


def test_nested_errors_are_gathered(spark):
    kind = {"type": "struct", "fields": [{"id": 1, "name": "a", "required": True, "type": "int"}, {"id": 2, "name": "k.3", "required": True, "type": "string"}, {"id": 3, "name": "l", "type": {"type": "list", "element": {"type": "map", "key": "string", "value": "long", "value-required": True}}}]}
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("V", iceberg_type(kind))])
    rows = [{"V": {"a": 1, "k.3": "x", "l": [{"q": 5}]}}, {"V": {"a": None, "b": 1, "l": [{"q": None}]}}, {"V": 5}, {"V": None}]
    got = conform(raw(spark, [(0, i, r) for i, r in enumerate(rows)]), schema)
    messages = {r.row_index: r.message for r in got.errors.collect()}
    for part in ("V.b: extra", "V.k\\.3: missing", "V.a: null", "V.l.list.element.key_value.value: null"):
        assert part in messages[1]
    assert set(messages) == {1, 2}
    assert got.good.where("row_index = 0").first().V.l == [{"q": 5}]


def test_map_rows_with_nested_columns_and_last_spelling(spark):
    """Of two spellings of a name the last wins; a row of maps gives nested columns as JSON text."""
    got = conform(raw(spark, [(0, 0, {"c1": 1, "C1": 2}), (0, 1, {"C1": 3, '"C1"': "x"})]), table_schema(ONE))
    assert values(got) == [2] and [r.row_index for r in got.errors.collect()] == [1]
    schema = table_schema([*ONE, {"name": "l", "sourceIcebergDataType": json.dumps({"type": "list", "element": "int"})}])
    rows = spark.createDataFrame([("t", "c", 0, 0, {"c1": " 5 ", "l": "[1, 2]"}), ("t", "c", 0, 1, {"c1": None}), ("t", "c", 0, 2, None), ("t", "c", 0, 3, {"l": "[1"})], "table string, channel string, batch_id long, row_index long, row_map map<string,string>")
    got = conform(rows, schema, row="row_map")
    assert {r.row_index: (r.C1, r.L) for r in got.good.collect()} == {0: (5, [1, 2]), 1: (None, None)}
    assert {r.row_index for r in got.errors.collect()} == {2, 3}


def test_all_is_generated_code(spark, sf):
    """No query of the loading operators, nor a table of all types, falls back from generated code."""
    from loadstone.plans import queries

    types = [
        {"name": "num", "logicalType": "FIXED", "physicalType": "SB16"}, {"name": "num_10_5", "logicalType": "FIXED", "physicalType": "SB8", "precision": 10, "scale": 5},
        {"name": "num_2_0", "logicalType": "FIXED", "physicalType": "SB1", "precision": 2, "scale": 0}, {"name": "num_18_0", "logicalType": "FIXED", "physicalType": "SB8", "precision": 18, "scale": 0},
        {"name": "num_float", "logicalType": "REAL"}, {"name": "str_varchar", "logicalType": "TEXT", "length": 256}, {"name": "bin", "logicalType": "BINARY", "byteLength": 256},
        {"name": "bl", "logicalType": "BOOLEAN"}, {"name": "var", "logicalType": "VARIANT"}, {"name": "obj", "logicalType": "OBJECT"}, {"name": "arr", "logicalType": "ARRAY"},
        {"name": "epochdays", "logicalType": "DATE"}, {"name": "timesec", "logicalType": "TIME", "physicalType": "SB4", "scale": 0}, {"name": "timenano", "logicalType": "TIME", "physicalType": "SB8", "scale": 9},
        {"name": "epochsec", "logicalType": "TIMESTAMP_NTZ", "physicalType": "SB8", "scale": 0}, {"name": "epochnano", "logicalType": "TIMESTAMP_NTZ", "physicalType": "SB16", "scale": 9},
        {"name": "zoned", "logicalType": "TIMESTAMP_TZ", "physicalType": "SB16", "scale": 9}, {"name": "local", "logicalType": "TIMESTAMP_LTZ", "physicalType": "SB8", "scale": 6},
    ]
    row = {"num": 1, "num_10_5": "1.5", "num_2_0": 9, "num_18_0": "1e3", "num_float": "inf", "str_varchar": "a", "bin": "00ff", "bl": "yes", "var": {"a": 1}, "obj": '{"b": 2}', "arr": [1], "epochdays": "2020-01-01", "timesec": "13:02", "timenano": "13:02:03.5", "epochsec": "2020-01-01T01:02", "epochnano": "2020-01-01T01:02:03.123456789", "zoned": "2020-01-01T01:02:03+01:00", "local": "1577840523"}
    only = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    for k, v in only.items():
        spark.conf.set(k, v)
    try:
        good = conform(raw(spark, [(0, i, row) for i in range(5)]), table_schema(types)).good.collect()
        assert len(good) == 5 and good[0].EPOCHNANO.nanos == 123456789 and good[0].NUM_18_0 == 1000
        for name in ("load_orders_statistics", "reject_extra_missing_null", "on_error_continue", "on_error_abort", "coerce_timestamp_ntz", "coerce_timestamp_tz", "coerce_date_local", "coerce_time_of_day", "variant_minify"):
            assert queries.queries()[name](spark, sf).count() > 0
    finally:
        for k in only:
            spark.conf.unset(k)


def test_every_query_has_sql_and_runs(spark, sf):
    """Those of the file, state and statistics modules that the other tests do not call."""
    from loadstone.plans import queries

    found = queries.queries()
    assert set(found) == set(queries.oracle_sql())
    for name in ("csv_load_history", "history_pages", "files_waiting", "manifest_statistics", "merged_files", "stats_zeros", "committed_offsets", "mismatch_events", "evolved_files", "tracked_channels"):
        assert found[name](spark, sf).count() > 0, name


def test_unquote_expression(spark):
    names = ["abc", '"aBc"', '"a""b"', "c\\ 5", '"a"b"', '""']
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(unquote_name(F.col("n"))).collect()] == ["ABC", "aBc", 'a"b', "C 5", '"A"B"', ""]


def test_merge_equals_direct(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_linenumber", "l_partkey", "l_tax", "l_returnflag")
    direct = stats.column_stats(rows.drop("l_linenumber"))
    merged = stats.merge_stats(stats.column_stats(rows, ["l_linenumber"]))
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert key(direct) == key(merged)
    assert stats.violations(direct).isEmpty()
    assert stats.unequal_columns(stats.column_stats(rows, ["l_linenumber"]).withColumn("w", F.lit(1)), ["l_linenumber"], ["w"]).isEmpty()


def test_truncated_bounds(spark):
    df = spark.createDataFrame([(bytearray(b"a" * 33),), (bytearray(b"\xff" * 33),), (bytearray(b"a" * 31 + b"\xff\xff"),), (bytearray(b"ab"),)], "b binary")
    got = [tuple(r) for r in df.select(stats.truncated_low(F.col("b")), stats.truncated_high(F.col("b"))).collect()]
    assert got == [("61" * 32, "61" * 31 + "62"), ("ff" * 32, "Z"), ("61" * 31 + "ff", "61" * 30 + "6200"), ("6162", "6162")]


def test_nested_leaf_statistics(spark):
    df = spark.createDataFrame([([1, None],), ([],), (None,), ([5],)], "l array<int>")
    row = stats.column_stats(df).first()
    assert (row.column, row.value_count, row.null_count, int(row.min_int), int(row.max_int)) == ("l.list.element", 5, 3, 1, 5)
    pairs = spark.createDataFrame([({"a": 2},), ({},)], "m map<string,int>")
    assert {r.column: r.null_count for r in stats.column_stats(pairs).collect()} == {"m.key_value.key": 1, "m.key_value.value": 1}


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None)], "i int, d double, s string")
    classic = {r.column: r for r in stats.file_properties(stats.column_stats(df)).collect()}
    assert int(classic["s"].min_int) == 0 and classic["s"].min_string is None
    iceberg = {r.column: r for r in stats.file_properties(stats.column_stats(df), iceberg=True).collect()}
    assert iceberg["s"].min_string == "" and iceberg["s"].min_int is None and int(iceberg["i"].min_int) == 0


def test_programs_by_type_give_the_same(spark, monkeypatch):
    """Wide tables are coerced by one program a type; here a narrow one is, and compared."""
    from loadstone.operators import conform as module

    number, text = {"logicalType": "FIXED", "physicalType": "SB8", "precision": 9, "scale": 1}, {"logicalType": "TEXT", "length": 4}
    nested = json.dumps({"type": "struct", "fields": [{"id": 1, "name": "a", "required": True, "type": "int"}]})
    columns = [{"name": "n1", **number}, {"name": "t1", **text}, {"name": "n2", **number, "nullable": False}, {"name": '"t2"', **text, "nullable": False}, {"name": "v", "logicalType": "VARIANT", "nullable": False}, {"name": "s", "sourceIcebergDataType": nested}, {"name": "b", "logicalType": "BOOLEAN"}]
    good = {"n1": 1.25, "t1": "abc", "N2": "7", '"t2"': "x", "v": {"k": [1]}, "s": {"a": 1}, "b": "yes"}
    rows = [good, {**good, "n1": "bad", "t1": "too long", "b": 3}, {**good, "n2": None}, {k: v for k, v in good.items() if k not in ("N2", '"t2"')}, {**good, "extra": 1, "more": 2}, {**good, "v": ""}, {**good, "s": {"b": 2}}, {"n2": 5, '"t2"': 12, "v": 1, "N1": None}, [1], {**good, "N2": 8, "n2": 9}]
    raw_rows = raw(spark, [(0, i, r) for i, r in enumerate(rows)])
    schema = table_schema(columns)
    maps = spark.createDataFrame([("t", "c", 0, i, m) for i, m in enumerate([{"n1": "1", "n2": "2", '"t2"': "abc", "v": "{}", "s": '{"a":1}'}, {"n2": None, '"t2"': "abcde"}, None, {"n2": "x", '"t2"': "y", "v": "1"}])], "table string, channel string, batch_id long, row_index long, row_map map<string,string>")
    for df, column in ((raw_rows, "row_json"), (maps, "row_map")):
        told = []
        for wide in (160, 0):
            monkeypatch.setattr(module, "WIDE", wide)
            checked = module.checked_rows(df, schema, row=column)
            told.append((checked.schema.simpleString(), sorted(map(repr, checked.select("row_index", "_row", "_bytes", "_error").collect()))))
        assert told[0] == told[1]


@pytest.mark.parametrize("n", [100, 1151])
def test_wide_tables(spark, n):
    """All kinds of columns, many of each; a row with one bad value and one without a required column."""
    kinds = [{"logicalType": "FIXED", "physicalType": "SB8", "precision": 18, "scale": 2}, {"logicalType": "REAL"}, {"logicalType": "TEXT", "length": 40}, {"logicalType": "TIMESTAMP_TZ", "physicalType": "SB16", "scale": 9}]
    columns = [{"name": f"c{i}", **kinds[i % 4], "nullable": i % 10 != 0} for i in range(n)]
    full = {f"c{i}": [i / 4, i / 8, f"text {i}", "2023-01-11T10:11:12.5+01:00"][i % 4] for i in range(n)}
    got = conform(raw(spark, [(0, 0, full), (0, 1, {**full, "c5": "bad"}), (0, 2, {k: v for k, v in full.items() if k != "c10"})]), table_schema(columns))
    row = got.good.collect()
    assert len(row) == 1 and row[0].C4 == 1 and row[0][f"C{n - 1}"] is not None and row[0].C3.epoch_s == 1673428272 and row[0].C6 == "text 6"
    assert {r.row_index: (r.code, r.message) for r in got.errors.collect()} == {1: ("0030", "c5: not a valid double"), 2: ("0004", "missing required columns: c10")}


def test_offsets(spark):
    b = spark.createDataFrame([("c", 0, "1", "4", 2), ("c", 1, "7", "7", 1), ("c", 2, "8", "9", 2), ("c", 3, None, "x", 9)], "channel string, batch_seq long, start_token string, end_token string, row_count long")
    assert [r.offset_ok for r in offsets.verify_offsets(b).orderBy("batch_seq").collect()] == [False, False, True, True]
    skipped = b.withColumn("status", F.when(F.col("batch_seq") == 1, "skipped").otherwise("loaded"))
    assert [r.offset_ok for r in offsets.verify_offsets(skipped).orderBy("batch_seq").collect()] == [False, None, False, True]
    mark = spark.createDataFrame([("c", 1)], "channel string, batch_seq long")
    assert offsets.channel_latest(b, flushed=mark).first().start_token == "8"
    last = offsets.channel_latest(b).first()
    assert (last.start_token, last.end_token, last.row_sequencer) == ("1", "x", 4)


def test_fencing_and_replay(spark):
    log = spark.createDataFrame([("c", 1, 0), ("c", 2, 1), ("c", 3, 0), ("c", 4, 2), ("c", 5, 1), ("c", 7, 2), ("c", 8, 2)], "channel string, batch_seq long, client_sequencer long")
    assert [r.batch_seq for r in offsets.fenced(log).where("accepted").orderBy("batch_seq").collect()] == [1, 2, 4, 7, 8]
    made = spark.createDataFrame([(1, [("a", 0)]), (2, [("a", 1), ("b", 0)])], "chunk_id long, channels array<struct<channel: string, client_sequencer: long>>")
    bad = spark.createDataFrame([("b", 0)], "channel string, client_sequencer long")
    assert [r.chunk_id for r in offsets.retry_chunks(made, bad).collect()] == [2]


def test_packing(spark):
    f = spark.createDataFrame([("t", i, b) for i, b in enumerate([300, 100, 150, 10, 500, 1])], "table string, flush_seq long, bytes long")
    assert [r.chunk_no for r in chunks.pack_chunks(f, max_chunk=260).orderBy("flush_seq").collect()] == [0, 1, 1, 1, 2, 3]
    with pytest.raises(chunks.MixedTables):
        chunks.concatenate(f, f.withColumn("table", F.lit("u")))


def packed(rows, limit, with_sets):
    """Chunk numbers by a loop over the flushes of each table."""
    out, by_table = {}, {}
    for row in rows:
        by_table.setdefault(row[0], []).append(row)
    for table, flushes in by_table.items():
        chunk, size, last = 0, 0, None
        for k, (_, seq, n, columns) in enumerate(sorted(flushes, key=lambda r: r[1])):
            own = columns if with_sets else None
            if k and (size + n > limit or own != last):
                chunk, size = chunk + 1, 0
            size, last = size + n, own
            out[table, seq] = chunk
    return out


@pytest.mark.parametrize(("limit", "block", "with_sets"), [(100, 16, True), (37, 64, False), (10**6, 7, False)])
def test_packing_by_jumps(spark, limit, block, with_sets):
    rng = random.Random(limit)
    rows = [(rng.choice(["hot", "hot", "b", None]), i, rng.choice([0, 1, 5, 30, 80, 120, rng.randrange(60)]), rng.choice("aaaab")) for i in range(800)]
    flushes = spark.createDataFrame(rows, "table string, flush_seq long, bytes long, column_set string")
    flushes = flushes.withColumn("row_count", F.lit(1)) if with_sets else flushes.drop("column_set")
    got = chunks.pack_chunks(flushes, max_chunk=limit, block=block)
    assert got.columns == [*flushes.columns, "chunk_no", "blob_no"]
    assert {(r.table, r.flush_seq): r.chunk_no for r in got.collect()} == packed(rows, limit, with_sets)
    assert chunks.pack_chunks(flushes.limit(0), max_chunk=limit).isEmpty()


def test_scans_equal_plain_windows(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "a", None, f"c{rng.randrange(30)}"]), rng.choice([None, *range(300)]), i, rng.choice([None, *range(-9, 9)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long, i long, v long")
    got = scans.scan(df, ["k"], ["o", "i"], {"b": ("before", F.col("v")), "s": ("sum", F.col("v")), "x": ("max", F.col("v")), "n": ("min", F.col("v"))}, ranges=16)
    w = Window.partitionBy("k").orderBy("o", "i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("*", F.lag("v").over(w).alias("b"), F.sum("v").over(upto).alias("s"), F.max("v").over(upto).alias("x"), F.min("v").over(upto).alias("n"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    peers = scans.scan(df, ["k"], ["o"], {"x": ("max", F.col("v"))}, peers=True, ranges=16)
    plain = df.withColumn("x", F.max("v").over(Window.partitionBy("k").orderBy("o")))
    assert sorted(map(repr, peers.collect())) == sorted(map(repr, plain.collect()))
    with pytest.raises(ValueError, match="measure"):
        scans.scan(df, ["k"], ["o"], {"x": ("median", F.col("v"))})


def test_a_hot_channel_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(12000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("channel"), F.col("id").alias("batch_seq"))
    batches = rows.select("*", F.col("batch_seq").cast("string").alias("start_token"), F.col("batch_seq").cast("string").alias("end_token"), F.lit(1).alias("row_count"))
    marked = batches.repartitionByRange(16, "channel", "batch_seq").withColumn("r", F.spark_partition_id())
    sizes = [r["count"] for r in marked.groupBy("r", "channel").count().groupBy("r").agg(F.sum("count").alias("count")).collect()]
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]
    assert offsets.verify_offsets(batches).where("channel = 'hot'").where("not offset_ok").count() == 3999


def test_files_of_bounded_size_and_compaction(spark, tmp_path):
    rows = spark.range(30000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), "id")
    sink.write_chunks(sink.identified(rows), f"file://{tmp_path}/by", ["k"], max_file_bytes=200_000)
    made = files.listed(spark, f"file://{tmp_path}/by", "*.parquet").collect()
    assert max(r["size"] for r in made) <= 200_000 and sum("k=hot" in r["path"] for r in made) >= 8
    sink.merge_files(spark, [f"file://{tmp_path}/by"], f"file://{tmp_path}/few", target_bytes=500_000)
    few = files.listed(spark, f"file://{tmp_path}/few", "*.parquet").collect()
    total = sum(r["size"] for r in made)
    assert total / 500_000 <= len(few) <= 2 * total / 500_000 + 1 < len(made) and max(r["size"] for r in few) <= 600_000
    merged = spark.read.parquet(f"file://{tmp_path}/few")
    assert merged.count() == 30000 and sink.duplicate_rows(merged).isEmpty()
    assert sink.duplicate_rows(merged.union(merged.where("id < 5"))).count() == 5
    told = {r.path: r.md5 for r in sink.file_digests(files.listed(spark, f"file://{tmp_path}/few", "*.parquet").withColumnRenamed("size", "length")).collect()}
    assert told and all(md5 == hashlib.md5(open(path.removeprefix("file:"), "rb").read()).hexdigest() for path, md5 in told.items())


def test_sink(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/orders.parquet")
    told = sink.write_verified(rows, f"file://{tmp_path}/v", iceberg=True)
    assert told["rows"] == rows.count()
    path = f"file://{tmp_path}/v/try={told['attempt']}"
    listed = sink.manifest(spark, path, "orders")
    assert listed.agg(F.sum("row_count")).first()[0] == rows.count() and listed.where("length(md5) <> 32").isEmpty()
    assert sink.with_row_identity(spark, path).select("file_id", "row_number").distinct().count() == rows.count()
    sink.merge_files(spark, [path], f"file://{tmp_path}/one")
    assert spark.read.parquet(f"file://{tmp_path}/one").count() == rows.count()
    assert missing_required(["A"], table_schema([{"name": "b", "logicalType": "REAL", "nullable": False}])) == ["b"]


def test_csv_files_load_once(spark, tmp_path):
    for name, text in (("test1.csv", "a,1\nb,2\nc,3\n"), ("test2.csv", "d,4\ne,x\nf,6\n")):
        (tmp_path / name).write_text(text)
    asked = files.wrapped_paths(spark, [(f"file://{tmp_path}/{n}", 12) for n in ("test1.csv", "test2.csv")])
    matched, unmatched = files.by_pattern(asked, r"test2.*\.csv$")
    assert [r.path[-9:] for r in unmatched.collect()] == ["test1.csv"]
    new, skipped = files.once_only(matched, spark.createDataFrame([], "path string"))
    assert new.count() == 1 and skipped.isEmpty()
    schema = table_schema([{"name": "STR", "logicalType": "TEXT"}, {"name": "NUM", "logicalType": "FIXED", "physicalType": "SB4", "precision": 9, "scale": 0}])
    got = conform(csv_lines.records(csv_lines.csv_as_rows(spark, [r.path for r in new.collect()], schema, "t")), schema, row="row_map")
    assert sorted(int(r.NUM) for r in got.good.collect()) == [4, 6] and got.errors.count() == 1
    with pytest.raises(ValueError):
        files.wrapped_paths(spark, [("x", -1)])


def test_history(spark):
    h = spark.createDataFrame([("a", 3, 0, True), ("b", 3, 1, True), ("c", 3, 3, True), ("d", 3, 0, False)], "path string, rows_parsed long, errors_seen long, complete boolean")
    assert [r.status for r in files.file_status(h).orderBy("path").collect()] == [2, 4, 3, 1]


def test_stream_and_replay(spark, tmp_path):
    rows = raw(spark, batches([1, "a"], [2], [3, 4]))
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    out = f"file://{tmp_path}/out"
    write = stream.load_batch(out, table_schema(ONE))
    for _ in range(2):  # the second run finds nothing new
        source = stream.row_stream(spark, f"{tmp_path}/in", rows.schema, files_per_trigger=1)
        source.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/cp").trigger(**stream.trigger(available_now=True)).start().awaitTermination()
    write(rows, 0)  # a replayed batch number adds nothing
    assert sorted(int(r.C1) for r in stream.loaded(spark, out).collect()) == [1, 2, 3, 4]


def test_channels(spark):
    state = spark.createDataFrame([("a", 0, 5, "9", True, 0)], stream.STATE)
    opened = {r.channel: r for r in stream.open_channel(stream.open_channel(state, "a"), "b", "T").collect()}
    assert (opened["a"].client_sequencer, opened["a"].end_token, opened["b"].client_sequencer, opened["b"].end_token) == (1, "9", 0, "T")
    assert stream.drop_channel(state, "a", 7).count() == 1 and stream.drop_channel(state, "a", 0).isEmpty()
    local = spark.createDataFrame([("a", 6)], "channel string, row_sequencer long")
    with pytest.raises(stream.NotCommitted) as told:
        stream.close_channels(local, state)
    assert [r.channel for r in told.value.channels.collect()] == ["a"] and "a" in str(told.value)
    for text, seconds in ((None, 1), ("2 minutes", 120), ("90", 90)):
        assert stream.max_client_lag(text) == seconds
    for bad in ("0", "11 minutes", "soon"):
        with pytest.raises(ValueError):
            stream.max_client_lag(bad)


def test_tracker(spark, tmp_path):
    b = spark.createDataFrame([("c", 0, 0, "0", "1", 2), ("c", 1, 0, "2", "3", 2), ("c", 2, 1, "5", "5", 1), ("c", 3, 0, "6", "6", 1)], "channel string, batch_seq long, client_sequencer long, start_token string, end_token string, row_count long")
    b.write.parquet(f"{tmp_path}/b")
    q = stream.track_channels(spark.readStream.schema(b.schema).parquet(f"{tmp_path}/b")).writeStream.format("memory").queryName("tracked").outputMode("update")
    q.option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = {r.batch_seq: (r.accepted, r.offset_ok) for r in spark.table("tracked").collect()}
    assert got == {0: (True, True), 1: (True, True), 2: (True, False), 3: (False, None)}


def test_percentiles_of_many_files_are_exact(spark):
    """A sketch is off by some ranks once a group has more files than its accuracy."""
    blobs = spark.range(200_000).select(F.lit("t").alias("table"), (F.col("id") * 7919 % 200_000).alias("build_ms"), F.lit(1).alias("bytes"), F.lit(1).alias("row_count"))
    got = sink.ingest_metrics(blobs.repartition(7), ["table"]).first()
    assert (got.build_ms_p50, got.build_ms_p95, got.build_ms_p99) == (99_999, 189_999, 197_999)
    wide = blobs.select("table", F.lit(1 << 40).alias("bytes"), "row_count", F.lit(1).alias("upload_ms"))
    assert sink.ingest_metrics(wide).first().bytes_per_second == 1000.0 * (1 << 40)


def test_manifest_of_flags_with_several_files(spark, sf, monkeypatch):
    """A flag with more rows than a file takes still has one row a column, with the statistics of all its files."""
    from loadstone.plans import file_queries

    write = sink.write_chunks
    monkeypatch.setattr(file_queries.sink, "write_chunks", lambda *args, **more: write(*args, **more, max_file_bytes=40_000))
    got = file_queries.manifest_statistics(spark, sf).collect()
    rows = {r[0]: r[1:] for r in spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").agg(F.count("*"), F.min("l_partkey"), F.max("l_partkey")).collect()}
    assert len(got) == 6 * len(rows) and all(r.sound and r.row_count == rows[r.flag][0] for r in got)
    assert {r.flag: (r.row_count, r.low, r.high) for r in got if r.column == "l_partkey"} == rows


def test_merging_makes_fewer_files_of_larger_tables(spark, sf, tmp_path, monkeypatch):
    """A larger table has more small files: their number does not stay while each outgrows the target."""
    from loadstone.plans import file_queries

    merge = sink.merge_files
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").crossJoin(spark.range(10).withColumnRenamed("id", "i"))
    lines.withColumn("l_orderkey", F.col("l_orderkey") + F.col("i") * 1_000_000).drop("i").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(file_queries.sink, "merge_files", lambda *args, target_bytes: merge(*args, target_bytes=24_000))
    monkeypatch.setattr(file_queries, "SMALL_FILE_ROWS", 500, raising=False)
    got = file_queries.merged_files(spark, str(tmp_path)).collect()
    assert len(got) == 3 and all(r.fewer_files and r.in_order and r.duplicates == 0 for r in got)
    assert sum(r.rows for r in got) == lines.count()


def test_exact_distinct_counts_are_not_sorted_for(spark):
    """Rows are not sorted once for each column; nulls, zeros, groups of null and columns without values count as count(DISTINCT) has them."""
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), (F.col("id") % 17).cast("string").alias("s"), F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0).alias("z"),
        F.nullif(F.col("id") % 5, F.lit(0)).alias("n"), F.lit(None).cast("string").alias("e"), F.encode((F.col("id") % 7).cast("string"), "utf-8").alias("b"),
    )
    for by in ([], ["g"]):
        want = {(r["g"] if by else None, c): r[c] for r in rows.groupBy(*by).agg(*[F.count_distinct(c).alias(c) for c in "szneb"]).collect() for c in "szneb"}
        told = stats.column_stats(rows if by else rows.drop("g"), by, distinct="exact")
        assert {(r["g"] if by else None, r.column): r.distinct_count for r in told.collect()} == want
    plan = stats.column_stats(rows.drop("g"), distinct="exact").select("distinct_count")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Sort [" not in plan
    assert stats.column_stats(rows.drop("g").limit(0), distinct="exact").where("distinct_count <> 0").isEmpty()


def test_nested_rows_are_dealt_to_more_tasks_of_a_larger_input(spark, sf, monkeypatch):
    """Tasks stay short however large the input is; the rows are those of the SQL."""
    from loadstone.operators import conform as operator
    from loadstone.plans import queries

    size = sum(f.stat().st_size for f in [Path(sf) / "events.parquet"])
    monkeypatch.setattr(operator, "NESTED_SPLIT", size // 40, raising=False)
    good, errors = queries.queries()["nested_values"](spark, sf), queries.queries()["nested_errors"](spark, sf)
    assert good.rdd.getNumPartitions() >= 30 and errors.rdd.getNumPartitions() >= 30
    bad = " OR ".join(f"event_id % {k} = 0" for k in (7, 11, 13, 17, 19))
    events = spark.read.parquet(f"{sf}/events.parquet")
    assert {tuple(r) for r in good.select("row_index", "a", "k", "items").collect()} == {tuple(r) for r in events.where(f"NOT ({bad})").selectExpr("event_id", "event_id", "event_type", "user_id + 2").collect()}
    assert errors.count() == events.where(bad).count()


def test_a_task_of_nested_rows_holds_no_more_of_a_larger_input(spark):
    """Rows of a task do not grow from 0.8 to 8 MB of input."""
    from pyspark.sql import types as T

    from loadstone.operators.conform import spread

    schema = T.StructType([T.StructField("V", T.ArrayType(T.IntegerType()))])
    held = [n / spread(spark.range(n), schema).rdd.getNumPartitions() for n in (100_000, 1_000_000)]
    assert held[1] < 1.25 * held[0]
