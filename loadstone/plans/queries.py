"""Registered queries of the loading operators, each with its DuckDB form.

Every query reads the given tables whole; rules for bad rows are ones that SQL
can state too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.functions import coerce as C
from loadstone.operators import chunks, offsets, stats
from loadstone.operators.conform import conform, unquote_name
from loadstone.plans.registry import ORACLE, QUERIES, Query, query
from loadstone.plans.registry import read as _read
from loadstone.plans.schema import iceberg_type, schema_of, table_schema
from loadstone.sources import files

def queries() -> dict[str, Query]:
    from loadstone.plans import file_queries, state_queries  # noqa: F401  # they register theirs

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLE)


# --- coercion ------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE cast(cast(l_extendedprice AS VARCHAR) AS DECIMAL(10,1))::DOUBLE END AS price,
  CASE WHEN l_orderkey % 13 = 0 THEN '0030' END AS code FROM lineitem""")
def coerce_decimal_half_up(spark, sf_dir):
    """COER2, COER3"""
    text = F.when(F.col("l_orderkey") % 13 == 0, F.lit("0x22")).otherwise(F.col("l_extendedprice").cast("string"))
    rows = C.coerced(_read(spark, sf_dir, "lineitem"), {"r": C.decimal.parts(text, F.lit("string"), 10, 1)})
    return rows.select("l_orderkey", "l_linenumber", F.col("r.value").cast("double").alias("price"), "r.code")


@query("""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN NULL WHEN 4 THEN false WHEN 5 THEN true ELSE NULL END AS flag,
  CASE WHEN o_orderkey % 7 IN (3, 6) THEN '0030' END AS code FROM orders""")
def coerce_boolean_words(spark, sf_dir):
    """COER1"""
    words = F.array(*map(F.lit, ["on", " Off ", "YES", "x", "f", "TruE", ""]))
    rows = C.coerced(_read(spark, sf_dir, "orders"), {"r": C.boolean.parts(words[(F.col("o_orderkey") % 7).cast("int")], F.lit("string"))})
    return rows.select("o_orderkey", F.col("r.value").alias("flag"), "r.code")


@query("""SELECT event_id, epoch_us(ts) // 1000000 AS epoch_s, CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN (epoch_us(ts) // 1000 % 1000) * 1000000 ELSE (epoch_us(ts) % 1000000) * 1000 END AS nanos FROM events""")
def coerce_epoch_guess(spark, sf_dir):
    """COER17"""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    text = F.when(F.col("event_id") % 3 == 0, F.floor(micros / 1_000_000)).when(F.col("event_id") % 3 == 1, F.floor(micros / 1000)).otherwise(micros).cast("string")
    rows = C.coerced(_utc(spark, sf_dir, "events", "ts"), {"g": C.epoch_guess.parts(text)})
    return rows.select("event_id", "g.epoch_s", F.col("g.nanos").cast("bigint").alias("nanos"))


def _utc(spark, sf_dir, table, column):
    """The table with a wall-clock column as the same wall clock in UTC, whatever the session zone."""
    return _read(spark, sf_dir, table).withColumn(column, F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column)))


#: The instant and the wall clock of the texts of _iso(): odd keys have an offset of -7 hours and a region, whose clock it is.
_ZONED = """WITH w AS (SELECT o_orderkey, o_orderdate::DATE + TIME '13:45:10.25' AS w, o_orderkey % 2 = 0 AS plain FROM orders),
  z AS (SELECT o_orderkey, w + CASE WHEN plain THEN INTERVAL (-9) HOUR ELSE INTERVAL 7 HOUR END AS utc, CASE WHEN plain THEN w ELSE timezone('America/Los_Angeles', timezone('UTC', w + INTERVAL 7 HOUR)) END AS own FROM w)"""


@query(f"{_ZONED} SELECT o_orderkey, own AS at FROM z")
def coerce_timestamp_ntz(spark, sf_dir):
    """COER15, COER16: with a region the wall clock is the region's"""
    rows = C.coerced(_read(spark, sf_dir, "orders"), {"r": C.timestamp.parts(_iso(), F.lit("string"), "TIMESTAMP_NTZ", 6)})
    return rows.select("o_orderkey", F.col("r.value").alias("at"))


def _iso():
    return F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T13:45:10.25"), F.when(F.col("o_orderkey") % 2 == 0, "+09:00").otherwise("-07:00[America/Los_Angeles]"))


@query(f"""{_ZONED}, x AS (SELECT o_orderkey, epoch_us(utc) // 1000000 AS epoch_s, (epoch_us(own) - epoch_us(utc)) // 60000000 AS offset_min FROM z)
  SELECT o_orderkey, epoch_s::BIGINT AS epoch_s, 250000000 AS nanos, offset_min::INTEGER AS offset_min, (epoch_s::HUGEINT * 1000 + 250)::VARCHAR AS scaled, ((epoch_s::HUGEINT * 1000 + 250) * 16384 + offset_min + 1440)::VARCHAR AS zoned FROM x""")
def coerce_timestamp_tz(spark, sf_dir):
    """COER15, COER18, COER19: the zoned timestamp, and the integers it is kept as at scale 3."""
    rows = C.coerced(_read(spark, sf_dir, "orders"), {"r": C.timestamp.parts(_iso(), F.lit("string"), "TIMESTAMP_TZ", 9)}).select("o_orderkey", "r.value.*")
    at = (F.col("epoch_s"), F.col("nanos"))
    return rows.select("o_orderkey", "epoch_s", "nanos", "offset_min", C.scaled_timestamp(*at, 3).cast("string").alias("scaled"), C.zoned_timestamp(*at, F.col("offset_min"), 3).cast("string").alias("zoned"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '-' || strftime(o_orderdate, '%Y-%m-%d') ELSE o_orderdate::DATE::VARCHAR END AS day,
  CASE WHEN o_orderkey % 5 = 0 THEN '0030' END AS code FROM orders WHERE o_orderkey % 5 <> 1 OR strftime(o_orderdate, '%m-%d') <> '02-29'""")
def coerce_date_local(spark, sf_dir):
    """COER13: the local date; years before 0; days that are none, offsets and regions that are none"""
    iso, day = _iso(), F.date_format("o_orderdate", "yyyy-MM-dd")
    wrong = F.element_at(F.array(*map(F.lit, ("2023-02-30", "2020-01-01T10:00:00+19:00", "2020-01-01T10:00:00[Europe/Paris]", "2020-01-01T10:00:00+01:00[nowhere]"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    text = F.when(F.col("o_orderkey") % 5 == 0, wrong).when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("-"), day)).otherwise(iso)
    rows = _read(spark, sf_dir, "orders").where((F.col("o_orderkey") % 5 != 1) | (F.date_format("o_orderdate", "MM-dd") != "02-29"))
    rows = C.coerced(rows, {"r": C.date.parts(text, F.lit("string"))})
    return rows.select("o_orderkey", F.col("r.value").cast("string").alias("day"), "r.code")


@query("""WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey::VARCHAR AS d, l_linenumber * 5 - 20 AS e FROM lineitem), t AS (SELECT *, rtrim(d, '0') AS s, length(d) - length(rtrim(d, '0')) + e AS z FROM n)
  SELECT l_orderkey, l_linenumber, CASE WHEN s = '' THEN '0' WHEN z >= 0 THEN s || repeat('0', z) WHEN length(s) > -z THEN substr(s, 1, length(s) + z) || '.' || substr(s, length(s) + z + 1) ELSE '0.' || repeat('0', -z - length(s)) || s END AS plain FROM t""")
def coerce_plain_numbers(spark, sf_dir):
    """COER8: numbers with exponents from -15 to 15 as plain text"""
    text = F.concat(F.col("l_partkey").cast("string"), F.lit("e"), (F.col("l_linenumber") * 5 - 20).cast("string"))
    rows = C.coerced(_read(spark, sf_dir, "lineitem"), {"r": C.string.parts(text, F.lit("number"))})
    return rows.select("l_orderkey", "l_linenumber", F.col("r.value").alias("plain"))


@query("SELECT event_id, (epoch_us(ts) // 1000 % 86400000)::BIGINT AS ms FROM events")
def coerce_time_of_day(spark, sf_dir):
    """COER14"""
    rows = C.coerced(_read(spark, sf_dir, "events"), {"r": C.time.parts(F.date_format("ts", "HH:mm:ss.SSSSSS"), F.lit("string"), 3)})
    return rows.select("event_id", F.col("r.value").alias("ms"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN octet_length(encode(p_name)) END AS n, CASE WHEN p_partkey % 7 <> 0 THEN lower(hex(encode(p_name))) END AS digits, CASE WHEN p_partkey % 7 = 0 THEN '0030' END AS code,
  CASE WHEN p_partkey % 7 = 0 OR octet_length(encode(p_name)) <> 22 THEN '0030' END AS fixed_code FROM part""")
def coerce_binary_hex(spark, sf_dir):
    """COER11, COER12: any length, and exactly 22 bytes"""
    text = F.concat(F.hex(F.encode("p_name", "utf-8")), F.when(F.col("p_partkey") % 7 == 0, "0").otherwise(""))
    rows = C.coerced(_read(spark, sf_dir, "part"), {"r": C.binary.parts(text, F.lit("string")), "x": C.binary.parts(text, F.lit("string"), exact_bytes=22)})
    return rows.select("p_partkey", F.octet_length("r.value").cast("bigint").alias("n"), F.lower(F.hex("r.value")).alias("digits"), "r.code", F.col("x.code").alias("fixed_code"))


@query("SELECT p_partkey, CASE WHEN length(p_name) <= 20 THEN p_name END AS name, CASE WHEN length(p_name) > 20 THEN '0030' END AS code FROM part")
def coerce_string_limit(spark, sf_dir):
    """COER8-10"""
    rows = C.coerced(_read(spark, sf_dir, "part"), {"r": C.string.parts(F.col("p_name"), F.lit("string"), 20)})
    return rows.select("p_partkey", F.col("r.value").alias("name"), "r.code")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 4 THEN NULL ELSE floor(l_quantity / 2 + 0.5)::INTEGER END AS half, CASE WHEN l_linenumber = 4 THEN 'nan' ELSE (l_quantity / 2)::VARCHAR END AS as_double,
  CASE WHEN l_linenumber <> 4 THEN floor(l_quantity / 2 + 0.5)::BIGINT * 4000000000 END AS wide, CASE WHEN l_linenumber = 4 THEN '0030' END AS code,
  CASE WHEN l_linenumber <> 4 THEN (l_quantity / 2)::FLOAT::DOUBLE END AS single FROM lineitem""")
def coerce_integer_double(spark, sf_dir):
    """COER4-7: double, float, int and bigint; what is over the range of int is for bigint only"""
    given = F.col("l_linenumber") == 4
    text = F.when(given, F.lit("Nan")).otherwise((F.col("l_quantity") / 2).cast("string"))
    wide = F.when(given, F.lit("1e19")).otherwise((F.floor(F.col("l_quantity") / 2 + 0.5) * 4_000_000_000).cast("string"))
    rows = C.coerced(_read(spark, sf_dir, "lineitem"), {
        "i": C.integer.parts(text, F.lit("string")), "d": C.double.parts(text, F.lit("string")), "w": C.integer.parts(wide, F.lit("string"), "bigint"),
        "f": C.float32.parts(text, F.lit("string")),
    })
    single = F.when(~F.isnan("f.value"), F.col("f.value").cast("double"))
    return rows.select("l_orderkey", "l_linenumber", F.col("i.value").alias("half"), F.lower(F.col("d.value").cast("string")).alias("as_double"), F.col("w.value").alias("wide"), "w.code", single.alias("single"))


_MINIFY = r"""regexp_replace(props, '("(?:\\.|[^"\\])*")|\s+', '\1', 'g')"""


@query(f"SELECT event_id, {_MINIFY} AS small, '[' || {_MINIFY} || ']' AS wrapped, CASE WHEN event_id % 9 = 0 THEN '0030' END AS code FROM events")
def variant_minify(spark, sf_dir):
    """COER20-23"""
    broken = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit('{"a":1,"a":'), F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    rows = C.coerced(_read(spark, sf_dir, "events"), {"v": C.variant.parts(F.col("props"), F.lit("string")), "a": C.array.parts(F.col("props"), F.lit("string")), "o": C.object_.parts(broken, F.lit("string"))})
    return rows.select("event_id", F.col("v.value").alias("small"), F.col("a.value").alias("wrapped"), F.col("o.code").alias("code"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || '"' ELSE upper(p_name) END AS name FROM part""")
def unquote_names(spark, sf_dir):
    """CONF1"""
    plain = F.replace("p_name", F.lit(" "), F.lit("\\ "))
    written = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit('"'), F.col("p_name"), F.lit('"""'))).otherwise(plain)
    return _read(spark, sf_dir, "part").select("p_partkey", unquote_name(written).alias("name"))


# --- rows and policies -----------------------------------------------------------

_ORDERS = table_schema([
    {"name": "O_ORDERKEY", "logicalType": "FIXED", "physicalType": "SB8", "precision": 18, "scale": 0, "nullable": False},
    {"name": "O_TOTALPRICE", "logicalType": "FIXED", "physicalType": "SB16", "precision": 12, "scale": 1},
    {"name": '"status"', "logicalType": "TEXT", "length": 1, "nullable": False},
    {"name": "O_ORDERPRIORITY", "logicalType": "TEXT"},
])


def orders_rows(spark, sf_dir):
    """orders as JSON rows: some lack a column, have one too many, a null or a bad number."""
    k = F.col("o_orderkey")
    price = F.when(k % 17 == 0, F.lit("honk")).otherwise(F.col("o_totalprice").cast("string"))
    status = F.when(k % 11 == 0, None).otherwise(F.col("o_orderstatus"))
    fields = [F.lit("o_orderkey"), k.cast("string"), F.lit("O_TotalPrice"), price]
    row = F.map_concat(
        F.create_map(*fields), F.when(k % 13 == 0, F.create_map()).otherwise(F.create_map(F.lit('"status"'), status)),
        F.when(k % 19 == 0, F.create_map(F.lit("zz top"), F.lit("1"))).otherwise(F.create_map()),
        F.when(k % 3 == 0, F.create_map()).otherwise(F.create_map(F.lit("o_orderpriority"), F.col("o_orderpriority"))),
    )
    return _read(spark, sf_dir, "orders").select(F.lit("orders").alias("table"), (k % 4).cast("string").alias("channel"), F.floor(k / 400).alias("batch_id"), k.alias("row_index"), F.to_json(row, {"ignoreNullFields": "false"}).alias("row_json"))


@query("""SELECT o_orderkey AS row_index, CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 THEN '0004' ELSE '0030' END AS code,
  CASE WHEN o_orderkey % 19 = 0 THEN 'zz top' WHEN o_orderkey % 13 = 0 THEN '"status"' WHEN o_orderkey % 11 = 0 THEN '"status"' ELSE '' END AS names,
  CASE WHEN o_orderkey % 19 = 0 THEN 'extra' WHEN o_orderkey % 13 = 0 THEN 'missing' WHEN o_orderkey % 11 = 0 THEN 'null' ELSE 'value' END AS what
  FROM orders WHERE o_orderkey % 19 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 17 = 0""")
def reject_extra_missing_null(spark, sf_dir):
    """CONF2-5, CONF7, CONF11, CONF13, SCH1, SCH9"""
    errors = conform(orders_rows(spark, sf_dir), _ORDERS).errors
    what = F.when(F.col("extra_columns").isNotNull(), "extra").when(F.col("missing_not_null").isNotNull(), "missing").when(F.col("null_not_null").isNotNull(), "null").otherwise("value")
    return errors.select("row_index", "code", F.array_join(F.coalesce("extra_columns", "missing_not_null", "null_not_null", F.array()), ",").alias("names"), what.alias("what"))


_GOOD = "o_orderkey % 19 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 17 <> 0"


@query(f"""WITH good AS (SELECT o_orderkey, cast(cast(o_totalprice AS VARCHAR) AS DECIMAL(12,1)) AS price, o_orderstatus AS s, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders WHERE {_GOOD})
  SELECT 'O_ORDERKEY' AS "column", count(*) AS row_count, 0 AS null_count, min(o_orderkey)::BIGINT AS min_int, max(o_orderkey)::BIGINT AS max_int, NULL AS min_string, NULL AS max_string, 0 AS max_length FROM good
  UNION ALL SELECT 'O_TOTALPRICE', count(*), 0, (min(price) * 10)::BIGINT, (max(price) * 10)::BIGINT, NULL, NULL, 0 FROM good
  UNION ALL SELECT 'status', count(*), 0, 0, 0, lower(hex(encode(min(s)))), lower(hex(encode(max(s)))), max(octet_length(encode(s))) FROM good
  UNION ALL SELECT 'O_ORDERPRIORITY', count(*), count(*) FILTER (WHERE p IS NULL), 0, 0, lower(hex(encode(min(p)))), lower(hex(encode(max(p)))), max(octet_length(encode(p))) FROM good""")
def load_orders_statistics(spark, sf_dir):
    """The flagship: rows in, which failed, and the column statistics of what is kept."""
    good = conform(orders_rows(spark, sf_dir), _ORDERS).good
    out = stats.file_properties(stats.column_stats(good.drop("table", "channel", "batch_id", "row_index")))
    return out.select("column", "row_count", "null_count", F.col("min_int").cast("bigint").alias("min_int"), F.col("max_int").cast("bigint").alias("max_int"), "min_string", "max_string", "max_length")


_EVENT = table_schema([{"name": "VALUE", "logicalType": "FIXED", "physicalType": "SB16", "precision": 38, "scale": 2}, {"name": "PROPS", "logicalType": "VARIANT"}])


def event_rows(spark, sf_dir):
    """events as rows; a value over 300 is text that is no number."""
    value = F.when(F.col("value") > 300, F.lit("much")).otherwise(F.col("value").cast("decimal(20,4)").cast("string"))
    row = F.to_json(F.create_map(F.lit("value"), value, F.lit("props"), F.col("props")))
    return _read(spark, sf_dir, "events").select(F.lit("events").alias("table"), (F.col("user_id") % 4).cast("string").alias("channel"), F.floor(F.col("event_id") / 100).alias("batch_id"), F.col("event_id").alias("row_index"), row.alias("row_json"))


_BATCHED = "WITH e AS (SELECT *, (user_id % 4)::VARCHAR AS channel, event_id // 100 AS batch_id, value > 300 AS bad FROM events), b AS (SELECT channel, batch_id, bool_or(bad) AS any_bad FROM e GROUP BY ALL)"


@query(f"{_BATCHED} SELECT channel, batch_id, count(*) AS row_count, count(*) FILTER (WHERE bad) AS error_rows, count(*) FILTER (WHERE NOT bad) AS loaded_rows, 'loaded' AS status FROM e GROUP BY ALL")
def on_error_continue(spark, sf_dir):
    """POL1, CONF12"""
    return conform(event_rows(spark, sf_dir), _EVENT).report.select("channel", "batch_id", "row_count", "error_rows", F.col("loaded_rows").cast("bigint").alias("loaded_rows"), "status")


@query(f"{_BATCHED} SELECT e.channel, e.batch_id, min(event_id) FILTER (WHERE bad) AS row_index, '0030' AS code FROM e JOIN b USING (channel, batch_id) WHERE any_bad GROUP BY ALL")
def on_error_abort(spark, sf_dir):
    """POL2, ORD2: the first bad row of each aborted batch"""
    return conform(event_rows(spark, sf_dir), _EVENT, "abort").errors.select("channel", "batch_id", "row_index", "code")


@query(f"{_BATCHED} SELECT event_id AS row_index, e.channel, e.batch_id FROM e JOIN b USING (channel, batch_id) WHERE NOT any_bad")
def on_error_skip_batch(spark, sf_dir):
    """POL3: rows of batches without a bad row"""
    return conform(event_rows(spark, sf_dir), _EVENT, "skip_batch").good.select("row_index", "channel", "batch_id")


@query(f"""{_BATCHED} SELECT event_id AS row_index FROM e JOIN b USING (channel, batch_id) WHERE NOT bad AND (NOT any_bad OR channel IN ('0', '1'))""")
def on_error_by_channel(spark, sf_dir):
    """POL4: a policy per channel"""
    rows = event_rows(spark, sf_dir)
    policies = rows.select("table", "channel").distinct().withColumn("on_error", F.when(F.col("channel").isin("0", "1"), "CONTINUE").otherwise("SKIP_BATCH"))
    return conform(rows, _EVENT, policies).good.select("row_index")


_NESTED = T.StructType([T.StructField("V", iceberg_type({"type": "struct", "fields": [
    {"id": 1, "name": "a", "required": True, "type": "long"}, {"id": 2, "name": "k.3", "type": "string"},
    {"id": 3, "name": "l", "type": {"type": "list", "element": "int"}}, {"id": 4, "name": "m", "type": {"type": "map", "key": "string", "value": "double", "value-required": True}},
]}))])


def nested_rows(spark, sf_dir):
    """events as nested values; by the id a field is missing, null, too many, or of the wrong shape."""
    k, one = F.col("event_id"), lambda name, value: F.concat(F.lit(f'"{name}":'), value)
    a = F.when(k % 7 == 0, None).when(k % 13 == 0, one("a", F.lit("null"))).otherwise(one("a", k.cast("string")))
    extra = F.when(k % 11 == 0, one("z.z", F.lit("1")))
    items = F.when(k % 17 == 0, one("l", F.lit("5"))).otherwise(one("l", F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(", 2, null]"))))
    pairs = one("m", F.concat(F.lit('{"x": '), F.when(k % 19 == 0, F.lit("null")).otherwise(F.col("value").cast("decimal(20,2)").cast("string")), F.lit(', "y": 1}')))
    row = F.concat(F.lit('{"V":{'), F.concat_ws(", ", a, extra, one("k.3", F.concat(F.lit('"'), "event_type", F.lit('"'))), items, pairs), F.lit("}}"))
    return _read(spark, sf_dir, "events").select(F.lit("t").alias("table"), F.lit("c").alias("channel"), F.floor(k / 100).alias("batch_id"), k.alias("row_index"), row.alias("row_json"))


_NESTED_BAD = "event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0"


@query(f"""SELECT event_id AS row_index, '0004' AS code, 'V: ' || concat_ws('; ', CASE WHEN event_id % 11 = 0 THEN 'V.z\\.z: extra' END, CASE WHEN event_id % 7 = 0 THEN 'V.a: missing' WHEN event_id % 13 = 0 THEN 'V.a: null' END,
  CASE WHEN event_id % 17 = 0 THEN 'V.l: not a list' END, CASE WHEN event_id % 19 = 0 THEN 'V.m.key_value.value: null' END) AS message FROM events WHERE {_NESTED_BAD}""")
def nested_errors(spark, sf_dir):
    """CONF8, COER25, SCH2, SCH4: errors of all levels of a nested value, with their paths"""
    return conform(nested_rows(spark, sf_dir), _NESTED).errors.select("row_index", "code", "message")


@query(f"""SELECT event_id AS row_index, event_id AS a, event_type AS k, user_id + 2 AS items, round(value::DECIMAL(20,2)::DOUBLE + 1, 2) AS pairs FROM events WHERE NOT ({_NESTED_BAD})""")
def nested_values(spark, sf_dir):
    """COER25: structs, lists and maps of the rows without errors"""
    good = conform(nested_rows(spark, sf_dir), _NESTED).good
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda x, y: x + F.coalesce(y, F.lit(0)).cast("double"))
    return good.select("row_index", "V.a", F.col("V.`k.3`").alias("k"), total("V.l").cast("bigint").alias("items"), F.round(total(F.map_values("V.m")), 2).alias("pairs"))


_TEXTS = table_schema([{"name": "T", "logicalType": "TEXT"}, {"name": "K", "logicalType": "FIXED", "physicalType": "SB8", "precision": 18, "scale": 0}])
_SIZED = "WITH s AS (SELECT doc_id, source, ceil(octet_length(encode(text)) + 4.25 + 8.25)::BIGINT AS bytes FROM documents)"


@query(f"""{_SIZED} SELECT source AS batch, count(*) AS row_count, count(*) FILTER (WHERE bytes > 4000) AS error_rows, coalesce(sum(bytes) FILTER (WHERE bytes <= 4000), 0)::BIGINT AS batch_bytes,
  coalesce(sum(bytes) FILTER (WHERE bytes <= 4000), 0) > 20000 AS warned, 'row over 4000 bytes: ' || max(bytes) FILTER (WHERE bytes > 4000) AS largest FROM s GROUP BY source""")
def row_and_batch_sizes(spark, sf_dir):
    """CONF9, CONF10: rows over a limit are errors, batches over another a warning"""
    row = F.to_json(F.create_map(F.lit("t"), F.col("text"), F.lit("k"), F.col("doc_id").cast("string")))
    raw = _read(spark, sf_dir, "documents").select(F.lit("documents").alias("table"), F.col("source").alias("channel"), F.lit(0).cast("long").alias("batch_id"), F.col("doc_id").alias("row_index"), row.alias("row_json"))
    got = conform(raw, _TEXTS, max_row_bytes=4000, batch_warning=20_000)
    largest = got.errors.groupBy("channel").agg(F.max_by("message", F.regexp_extract("message", r"(\d+)$", 1).cast("int")).alias("largest"))
    report = got.report.join(largest, "channel", "left")
    return report.select(F.col("channel").alias("batch"), "row_count", "error_rows", F.col("batch_bytes").cast("bigint").alias("batch_bytes"), (F.size("warnings") > 0).alias("warned"), "largest")


_REQUIRED_VARIANT = table_schema([{"name": "P", "logicalType": "VARIANT", "nullable": False}])


@query("SELECT event_id AS row_index, '0030' AS code, 'P: null in a required column' AS message FROM events WHERE event_id % 6 = 0")
def null_after_parsing(spark, sf_dir):
    """CONF6: blank text becomes null in a column that must not be"""
    text = F.when(F.col("event_id") % 6 == 0, "  ").otherwise(F.col("props"))
    raw = _read(spark, sf_dir, "events").select(F.lit("t").alias("table"), F.lit("c").alias("channel"), F.floor(F.col("event_id") / 100).alias("batch_id"), F.col("event_id").alias("row_index"), F.to_json(F.create_map(F.lit("p"), text)).alias("row_json"))
    return conform(raw, _REQUIRED_VARIANT).errors.select("row_index", "code", "message")


@query("""SELECT p_partkey, '[' || array_to_string(list_transform(range(0, octet_length(encode(p_brand))), lambda i: ('0x' || substr(hex(encode(p_brand)), (2 * i + 1)::INT, 2))::INTEGER), ',') || ']' AS as_bytes,
  '{"' || p_brand || '":' || p_size || '}' AS as_map, '["' || p_type || '",null]' AS as_list FROM part""")
def typed_values_as_json(spark, sf_dir):
    """COER24: bytes as numbers, maps and lists"""
    rows = _read(spark, sf_dir, "part").select("p_partkey", F.encode("p_brand", "utf-8").alias("b"), F.create_map("p_brand", "p_size").alias("m"), F.array("p_type", F.lit(None).cast("string")).alias("l"))
    return rows.select("p_partkey", *[C.typed_json(F.col(c), rows.schema[c].dataType).alias(n) for c, n in (("b", "as_bytes"), ("m", "as_map"), ("l", "as_list"))])


# --- statistics --------------------------------------------------------------------


@query("""SELECT l_returnflag, 'l_orderkey' AS "column", count(*) AS row_count, min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem GROUP BY ALL
  UNION ALL SELECT l_returnflag, 'l_linenumber', count(*), min(l_linenumber), max(l_linenumber) FROM lineitem GROUP BY ALL
  UNION ALL SELECT l_returnflag, 'l_shipdate', count(*), min(epoch_us(l_shipdate)), max(epoch_us(l_shipdate)) FROM lineitem GROUP BY ALL""")
def stats_int(spark, sf_dir):
    """AGG1-3"""
    rows = _read(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate")
    return stats.column_stats(rows, ["l_returnflag"]).select("l_returnflag", "column", "row_count", F.col("min_int").cast("bigint").alias("low"), F.col("max_int").cast("bigint").alias("high"))


@query("""WITH x AS (SELECT l_linestatus, l_extendedprice AS a, nullif(l_discount, 0.05) AS b FROM lineitem)
  SELECT l_linestatus, 'a' AS "column", count(*) AS row_count, count(*) - count(a) AS null_count, min(a) AS low, max(a) AS high FROM x GROUP BY ALL
  UNION ALL SELECT l_linestatus, 'b', count(*), count(*) - count(b), min(b), max(b) FROM x GROUP BY ALL""")
def stats_real(spark, sf_dir):
    """AGG2, AGG4"""
    rows = _read(spark, sf_dir, "lineitem").select("l_linestatus", F.col("l_extendedprice").alias("a"), F.nullif("l_discount", F.lit(0.05)).alias("b"))
    return stats.column_stats(rows, ["l_linestatus"]).select("l_linestatus", "column", "row_count", "null_count", F.col("min_real").alias("low"), F.col("max_real").alias("high"))


@query("SELECT lang, count(*) AS row_count, sha256(min(encode(text))) AS low, sha256(max(encode(text))) AS high, max(octet_length(encode(text))) AS max_length FROM documents GROUP BY ALL")
def stats_string(spark, sf_dir):
    """AGG5, AGG6"""
    out = stats.column_stats(_read(spark, sf_dir, "documents").select("lang", "text"), ["lang"])
    return out.select("lang", "row_count", F.sha2("min_bytes", 256).alias("low"), F.sha2("max_bytes", 256).alias("high"), "max_length")


@query("""WITH b AS (SELECT source, min(encode(text)) AS lo, max(encode(text)) AS hi FROM documents GROUP BY ALL)
  SELECT source, lower(left(hex(lo), 64)) AS min_string, CASE WHEN octet_length(hi) <= 32 THEN lower(hex(hi)) ELSE lower(left(hex(hi), 62) || printf('%02x', ('0x' || substr(hex(hi), 63, 2))::INTEGER + 1)) END AS max_string FROM b""")
def stats_truncated_bounds(spark, sf_dir):
    """AGG13"""
    out = stats.file_properties(stats.column_stats(_read(spark, sf_dir, "documents").select("source", "text"), ["source"]))
    return out.select("source", "min_string", "max_string")


@query("""SELECT 'p_brand' AS "column", count(DISTINCT p_brand) AS distinct_count FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part""")
def stats_ndv(spark, sf_dir):
    """AGG7"""
    return stats.column_stats(_read(spark, sf_dir, "part").select("p_brand", "p_type", "p_size"), distinct="exact").select("column", "distinct_count")


@query("""SELECT 'l_partkey' AS "column", count(*) AS row_count, min(l_partkey) AS low, max(l_partkey) AS high, NULL::DOUBLE AS low_real, NULL::DOUBLE AS high_real FROM lineitem
  UNION ALL SELECT 'l_tax', count(*), NULL, NULL, min(l_tax), max(l_tax) FROM lineitem""")
def stats_merge(spark, sf_dir):
    """AGG10: partial statistics by line number, merged"""
    parts = stats.column_stats(_read(spark, sf_dir, "lineitem").select("l_linenumber", "l_partkey", "l_tax"), ["l_linenumber"])
    out = stats.merge_stats(parts)
    return out.select("column", "row_count", F.col("min_int").cast("bigint").alias("low"), F.col("max_int").cast("bigint").alias("high"), F.col("min_real").alias("low_real"), F.col("max_real").alias("high_real"))


@query("""WITH v AS (SELECT label, unnest(CASE WHEN len(embedding) = 0 THEN [NULL] ELSE embedding END) AS x FROM embeddings)
  SELECT label, 'embedding.list.element' AS "column", count(*) AS value_count, count(*) - count(x) AS null_count, min(x)::DOUBLE AS low, max(x)::DOUBLE AS high FROM v GROUP BY ALL""")
def stats_nested_leaf(spark, sf_dir):
    """AGG8, AGG9"""
    out = stats.column_stats(_read(spark, sf_dir, "embeddings").select("label", "embedding"), ["label"])
    return out.select("label", "column", "value_count", "null_count", F.col("min_real").alias("low"), F.col("max_real").alias("high"))


@query("""WITH x AS (SELECT l_linenumber AS n, l_returnflag, l_shipdate::DATE - DATE '1992-01-01' AS d, l_quantity FROM lineitem)
  SELECT 'l_returnflag' AS "column", count(*) AS row_count, count(DISTINCT l_returnflag) AS distinct_count FROM x UNION ALL SELECT 'l_linenumber', count(*), count(DISTINCT n) FROM x UNION ALL SELECT 'l_quantity', count(*), count(DISTINCT l_quantity) FROM x""")
def stats_merge_distinct(spark, sf_dir):
    """SET4, AGG10: distinct counts of parts by date, merged by their sketches"""
    rows = _read(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("y"), "l_returnflag", "l_linenumber", "l_quantity")
    return stats.merge_stats(stats.column_stats(rows, ["y"], distinct="sketch")).select("column", "row_count", "distinct_count")


@query("""SELECT l_linestatus, '-0.0' AS low, CASE WHEN l_linestatus = 'F' THEN '0.0' ELSE '-0.0' END AS high FROM lineitem GROUP BY l_linestatus""")
def stats_zeros(spark, sf_dir):
    """AGG4: -0.0 is under 0.0; one group has both, the other -0.0 alone"""
    negative = (F.col("l_linenumber") % 2 == 0) | (F.col("l_linestatus") != "F")
    rows = _read(spark, sf_dir, "lineitem").select("l_linestatus", "l_linenumber", (F.when(negative, -1.0).otherwise(1.0) * F.col("l_linenumber") * 0.0).alias("z"))
    out = stats.merge_stats(stats.column_stats(rows, ["l_linestatus", "l_linenumber"]), ["l_linestatus"])
    return out.select("l_linestatus", F.col("min_real").cast("string").alias("low"), F.col("max_real").cast("string").alias("high"))


@query("""WITH x AS (SELECT l_linenumber AS part, l_orderkey % 3 AS chunk, l_partkey, l_tax FROM lineitem), p AS (SELECT part, chunk, count(*) AS n, min(l_partkey) AS a, max(l_partkey) AS b, min(l_tax) AS c, max(l_tax) AS d FROM x GROUP BY ALL)
  SELECT chunk, 'l_partkey' AS "column", sum(n)::BIGINT AS row_count, min(a) AS low, max(b) AS high, NULL::DOUBLE AS low_real, NULL::DOUBLE AS high_real, count(*) AS parts FROM p GROUP BY chunk
  UNION ALL SELECT chunk, 'l_tax', sum(n)::BIGINT, NULL, NULL, min(c), max(d), count(*) FROM p GROUP BY chunk""")
def chunk_statistics(spark, sf_dir):
    """AGG11: channels of a chunk merged column by column; all have one column set"""
    rows = _read(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 3).alias("chunk"), F.col("l_linenumber").alias("part"), "l_partkey", "l_tax")
    parts = stats.column_stats(rows, ["chunk", "part"])
    wrong = stats.unequal_columns(parts, ["part"], ["chunk"])
    merged = stats.merge_stats(parts, ["chunk"]).join(parts.groupBy("chunk", "column").agg(F.count("*").alias("parts")), ["chunk", "column"])
    return merged.join(wrong, "chunk", "left_anti").select("chunk", "column", "row_count", F.col("min_int").cast("bigint").alias("low"), F.col("max_int").cast("bigint").alias("high"), F.col("min_real").alias("low_real"), F.col("max_real").alias("high_real"), "parts")


@query("""WITH x AS (SELECT l_linenumber AS part, l_partkey FROM lineitem), c AS (SELECT part FROM x GROUP BY part)
  SELECT 0 AS chunk, 2 AS column_sets FROM c HAVING count(*) > 1""")
def chunk_column_sets(spark, sf_dir):
    """AGG11, SET2: a chunk whose channels do not have the same columns"""
    rows = _read(spark, sf_dir, "lineitem").select("l_linenumber", "l_partkey", "l_tax")
    parts = stats.column_stats(rows, ["l_linenumber"]).where("l_linenumber <> 2 OR column <> 'l_tax'")
    return stats.unequal_columns(parts.withColumn("chunk", F.lit(0)), ["l_linenumber"], ["chunk"]).select("chunk", F.col("column_sets").cast("int").alias("column_sets"))


@query("""WITH g AS (SELECT p_brand, count(*) AS n, count(*) FILTER (WHERE p_brand = 'Brand#11') AS kept, min(p_size) AS a, min(p_retailprice) AS b, min(p_name) AS c FROM part GROUP BY ALL)
  SELECT p_brand, k AS "column", dialect, n AS row_count, n - kept AS null_count,
    CASE WHEN k = 'i' AND kept > 0 THEN a WHEN dialect = 'classic' OR k = 'i' THEN 0 END::BIGINT AS min_int, CASE WHEN k = 'r' AND kept > 0 THEN b WHEN dialect = 'classic' OR k = 'r' THEN 0.0 END::DOUBLE AS min_real,
    CASE WHEN k = 's' AND kept > 0 THEN lower(left(hex(encode(c)), 64)) WHEN dialect = 'iceberg' AND k = 's' THEN '' END AS min_string
  FROM g, (VALUES ('i'), ('r'), ('s')) k(k), (VALUES ('classic'), ('iceberg')) d(dialect)""")
def stats_defaults(spark, sf_dir):
    """AGG14: columns without values, as both dialects register them"""
    given = F.col("p_brand") == "Brand#11"
    rows = _read(spark, sf_dir, "part").select("p_brand", F.when(given, F.col("p_size")).alias("i"), F.when(given, F.col("p_retailprice")).alias("r"), F.when(given, F.col("p_name")).alias("s"))
    measured = stats.column_stats(rows, ["p_brand"])
    both = stats.file_properties(measured).withColumn("dialect", F.lit("classic")).unionByName(stats.file_properties(measured, iceberg=True).withColumn("dialect", F.lit("iceberg")))
    return both.select("p_brand", "column", "dialect", "row_count", "null_count", F.col("min_int").cast("bigint").alias("min_int"), "min_real", "min_string")


@query("""SELECT l_returnflag, 'l_tax' AS "column", count(*) AS row_count, 2 * count(*) AS null_count, -1::BIGINT AS distinct_count FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL
  UNION ALL SELECT l_returnflag, 'l_partkey', count(*), 0, 7 FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL""")
def stats_violations(spark, sf_dir):
    """AGG15: more nulls than rows, and a distinct count where none was asked for"""
    measured = stats.column_stats(_read(spark, sf_dir, "lineitem").select("l_returnflag", "l_partkey", "l_tax"), ["l_returnflag"])
    spoilt = measured.withColumns({
        "null_count": F.when((F.col("l_returnflag") == "A") & (F.col("column") == "l_tax"), 2 * F.col("row_count")).otherwise(F.col("null_count")),
        "distinct_count": F.when((F.col("l_returnflag") == "R") & (F.col("column") == "l_partkey"), F.lit(7)).otherwise(F.col("distinct_count")),
    })
    return stats.violations(spoilt).select("l_returnflag", "column", "row_count", "null_count", "distinct_count")


@query("""WITH v AS (SELECT unnest(embedding) AS x FROM embeddings)
  SELECT 'vec_id' AS "column", 1 AS ordinal, 0 AS field_id, false AS repeated, 'bigint' AS type, count(*) AS n, min(vec_id)::DOUBLE AS low FROM embeddings
  UNION ALL SELECT 'embedding.list.element', 2, 0, true, 'float', count(*), min(x)::DOUBLE FROM v UNION ALL SELECT 'label', 3, 0, false, 'int', count(*), min(label)::DOUBLE FROM embeddings""")
def schema_leaves(spark, sf_dir):
    """SCH3, SCH5, SCH7: the leaves of a table's schema, with what was measured of each"""
    rows = _read(spark, sf_dir, "embeddings")
    told = schema_of(spark, rows.schema).join(stats.column_stats(rows), "column")
    n = F.when(F.col("value_count") < 0, F.col("row_count")).otherwise(F.col("value_count"))
    return told.select("column", "ordinal", "field_id", "repeated", "type", n.alias("n"), F.coalesce(F.col("min_int").cast("double"), "min_real").alias("low"))


# --- channels -----------------------------------------------------------------------

_EVENTS_B = """WITH b AS (SELECT event_id // 2500 AS channel, event_id // 100 AS batch_seq, count(*) AS row_count,
    ((event_id // 100) * 100 + CASE WHEN (event_id // 100) % 7 = 3 THEN 5 ELSE 0 END)::VARCHAR AS start_token, ((event_id // 100) * 100 + 99)::VARCHAR AS end_token FROM events GROUP BY ALL)"""


def event_batches(spark, sf_dir):
    """events as batches of a hundred; one in seven says that it begins five rows later than it does."""
    e = _read(spark, sf_dir, "events").select("event_id", F.floor(F.col("event_id") / 2500).alias("channel"), F.floor(F.col("event_id") / 100).alias("batch_seq"))
    b = e.groupBy("channel", "batch_seq").agg(F.count("*").alias("row_count"))
    late = F.when(F.col("batch_seq") % 7 == 3, 5).otherwise(0)
    return b.withColumns({"start_token": (F.col("batch_seq") * 100 + late).cast("string"), "end_token": (F.col("batch_seq") * 100 + 99).cast("string")})


@query(f"""{_EVENTS_B} SELECT channel, batch_seq, lag(end_token) OVER w AS previous_token,
  end_token::BIGINT - start_token::BIGINT + 1 = row_count AND coalesce(start_token::BIGINT = lag(end_token) OVER w::BIGINT + 1, true) AS offset_ok FROM b WINDOW w AS (PARTITION BY channel ORDER BY batch_seq)""".replace("lag(end_token) OVER w::BIGINT", "(lag(end_token) OVER w)::BIGINT"))
def offset_verify(spark, sf_dir):
    """WIN1, WIN2, UDF1"""
    return offsets.verify_offsets(event_batches(spark, sf_dir)).select("channel", "batch_seq", "previous_token", "offset_ok")


@query(f"""{_EVENTS_B} SELECT channel, arg_min(start_token, batch_seq) FILTER (WHERE batch_seq > channel * 25 + 9 OR channel % 2 = 1) AS start_token, arg_max(end_token, batch_seq) AS end_token, max(batch_seq) AS last_batch,
  count(*) AS row_sequencer, sum(row_count)::BIGINT AS rows_inserted FROM b GROUP BY ALL""")
def channel_latest(spark, sf_dir):
    """WIN3: the tenth batch of every other channel was the last to be flushed"""
    batches = event_batches(spark, sf_dir)
    flushed = batches.where(F.col("channel") % 2 == 0).select("channel", (F.col("channel") * 25 + 9).alias("batch_seq")).distinct()
    return offsets.channel_latest(batches, flushed=flushed)


@query(f"""{_EVENTS_B}, n AS (SELECT channel, batch_seq, batch_seq + (batch_seq % 25) // 20 AS row_sequencer FROM b),
  s AS (SELECT *, coalesce(row_sequencer = lag(row_sequencer) OVER w + 1, true) AS in_sequence FROM n WINDOW w AS (PARTITION BY channel ORDER BY row_sequencer))
  SELECT channel, batch_seq, in_sequence, bool_and(in_sequence) OVER (PARTITION BY channel ORDER BY row_sequencer) AS valid FROM s""")
def sequencer_gaps(spark, sf_dir):
    """WIN4: the numbers leap at the twentieth batch of each channel"""
    flushes = event_batches(spark, sf_dir).withColumn("row_sequencer", F.col("batch_seq") + F.floor(F.col("batch_seq") % 25 / 20))
    return offsets.sequencer_gaps(flushes).select("channel", "batch_seq", "in_sequence", "valid")


@query("SELECT event_id, (user_id % 4)::INTEGER AS channel, event_id % 50 // 10 = max(event_id % 50 // 10) OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS accepted FROM events")
def fenced_rows(spark, sf_dir):
    """STR6"""
    rows = _read(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 4).cast("int").alias("channel"), F.floor(F.col("event_id") % 50 / 10).alias("client_sequencer"))
    return offsets.fenced(rows, order="event_id").select("event_id", "channel", "accepted")


@query("""SELECT user_id AS channel, count(*) AS local_sequencer, CASE WHEN user_id % 5 = 0 THEN count(*) - 1 WHEN user_id % 7 <> 0 THEN count(*) END AS persisted_sequencer FROM events GROUP BY user_id
  HAVING user_id % 5 = 0 OR user_id % 7 = 0 OR user_id % 9 = 0""")
def uncommitted_channels(spark, sf_dir):
    """JOIN3"""
    local = _read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("channel")).agg(F.count("*").alias("row_sequencer"))
    state = local.where((F.col("channel") % 7 != 0) | (F.col("channel") % 5 == 0)).select("channel", (F.col("row_sequencer") - (F.col("channel") % 5 == 0).cast("int")).alias("row_sequencer"), F.when(F.col("channel") % 9 == 0, 20).otherwise(0).alias("status_code"))
    return offsets.uncommitted_channels(local, state).select("channel", "local_sequencer", "persisted_sequencer")


@query("SELECT event_id // 100 AS chunk_id, count(*) AS rows FROM events GROUP BY ALL HAVING bool_or(user_id % 97 = 0 AND event_id % 2 = 1)")
def retry_chunks(spark, sf_dir):
    """JOIN1"""
    e = _read(spark, sf_dir, "events").withColumns({"chunk_id": F.floor(F.col("event_id") / 100), "client_sequencer": F.col("event_id") % 2})
    made = e.groupBy("chunk_id").agg(F.count("*").alias("rows"), F.collect_set(F.struct(F.col("user_id").alias("channel"), "client_sequencer")).alias("channels"))
    rejected = e.where("user_id % 97 = 0").select(F.col("user_id").alias("channel"), F.lit(1).cast("long").alias("client_sequencer")).distinct()
    return offsets.retry_chunks(made, rejected).select("chunk_id", "rows")


# --- chunks and files -----------------------------------------------------------------


@query("""WITH RECURSIVE f AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY source) AS n, source, sum(octet_length(encode(text)))::BIGINT AS bytes FROM documents GROUP BY lang, source),
  p AS (SELECT lang, n, source, bytes, bytes AS size, 0 AS chunk_no FROM f WHERE n = 1
  UNION ALL SELECT f.lang, f.n, f.source, f.bytes, CASE WHEN p.size + f.bytes > 100000 THEN f.bytes ELSE p.size + f.bytes END, p.chunk_no + (p.size + f.bytes > 100000)::INT FROM p JOIN f ON f.lang = p.lang AND f.n = p.n + 1)
  SELECT lang, source, bytes, chunk_no::BIGINT AS chunk_no FROM p""")
def pack_chunks(spark, sf_dir):
    """WIN5: sources of a language as flushes, packed in order"""
    per = _read(spark, sf_dir, "documents").groupBy(F.col("lang").alias("table"), F.col("source").alias("flush_seq")).agg(F.sum(F.octet_length("text")).cast("bigint").alias("bytes"))
    return chunks.pack_chunks(per, max_chunk=100_000).select(F.col("table").alias("lang"), F.col("flush_seq").alias("source"), "bytes", "chunk_no")


@query("SELECT l_returnflag, l_linenumber, (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linenumber) - 1) // 3 AS blob_no, count(*) AS rows FROM lineitem GROUP BY l_returnflag, l_linenumber")
def chunks_in_blobs(spark, sf_dir):
    """WIN6"""
    made = _read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linenumber").agg(F.count("*").alias("rows"))
    return chunks.blobs_of_chunks(made, "l_linenumber", ["l_returnflag"], 3)


def file_ledger(spark, sf_dir):
    """documents by source and language as loaded files."""
    d = _read(spark, sf_dir, "documents")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.min("doc_id") * 60)
    out = d.groupBy(F.concat_ws("/", "source", "lang").alias("path")).agg(F.count("*").alias("rows_parsed"), F.count_if(F.col("n_chars") < 600).alias("errors_seen"), at.alias("last_insert_time"), (F.max("doc_id") % 10 != 0).alias("complete"))
    return out.withColumn("rows_inserted", F.col("rows_parsed") - F.col("errors_seen"))


_LEDGER = "WITH l AS (SELECT source || '/' || lang AS path, count(*) AS rows_parsed, count(*) FILTER (WHERE n_chars < 600) AS errors_seen, 1700000000 + min(doc_id) * 60 AS epoch_s, max(doc_id) % 10 <> 0 AS complete FROM documents GROUP BY ALL)"


@query(f"{_LEDGER} SELECT path, CASE WHEN NOT complete THEN 1 WHEN errors_seen = 0 THEN 2 WHEN errors_seen >= rows_parsed THEN 3 ELSE 4 END AS status, rows_parsed, errors_seen FROM l")
def file_status(spark, sf_dir):
    """SNK12"""
    return files.file_status(file_ledger(spark, sf_dir)).select("path", "status", "rows_parsed", "errors_seen")


@query(f"{_LEDGER} SELECT path, epoch_s, complete FROM l WHERE epoch_s >= 1700003600 AND epoch_s < 1700012000")
def history_range(spark, sf_dir):
    """SNK11"""
    out, _ = files.history_range(file_ledger(spark, sf_dir), F.timestamp_seconds(F.lit(1_700_003_600)), F.timestamp_seconds(F.lit(1_700_012_000)))
    return out.select("path", F.unix_seconds("last_insert_time").alias("epoch_s"), "complete")


@query(f"{_LEDGER}, r AS (SELECT DISTINCT source || '/' || lang AS path FROM documents) SELECT path, path IN (SELECT path FROM l WHERE complete) AS skipped, NOT regexp_matches(path, '^src1') AS unmatched FROM r")
def skipped_files(spark, sf_dir):
    """SRC3, SRC4, JOIN6"""
    asked = _read(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "lang").alias("path")).distinct()
    new, skipped = files.once_only(asked, file_ledger(spark, sf_dir).where("complete"))
    rows = new.withColumn("skipped", F.lit(False)).union(skipped.withColumn("skipped", F.lit(True)))
    matched, unmatched = files.by_pattern(rows, "^src1")
    return matched.withColumn("unmatched", F.lit(False)).union(unmatched.withColumn("unmatched", F.lit(True)))


@query("SELECT l_returnflag, count(*) AS rows, sum(l_quantity)::DOUBLE AS quantity, true AS verified FROM lineitem GROUP BY ALL")
def write_verify(spark, sf_dir):
    """SNK1, SNK6, SNK7: written, verified against the rows, read back"""
    from loadstone.sources import sink

    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = files.new_folder(spark, "chunks")
    told = sink.write_verified(rows, path, iceberg=True)
    back = spark.read.schema(rows.schema).parquet(f"{path}/try={told['attempt']}")
    return back.groupBy("l_returnflag").agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"), F.lit(True).alias("verified"))


@query(f"{_BATCHED} SELECT channel, batch_id, event_id AS row_index FROM e WHERE NOT bad")
def stream_equals_batch(spark, sf_dir):
    """STR1, STR3, STR4, SRC6: events through an AvailableNow stream, once each"""
    from loadstone.streaming import stream

    path = files.new_folder(spark, "stream")
    source = _read(spark, sf_dir, "events")
    source.write.parquet(f"{path}/in")

    def prepare(batch: DataFrame) -> DataFrame:
        value = F.when(F.col("value") > 300, F.lit("much")).otherwise(F.col("value").cast("decimal(20,4)").cast("string"))
        row = F.to_json(F.create_map(F.lit("value"), value, F.lit("props"), F.col("props")))
        return batch.select(F.lit("events").alias("table"), (F.col("user_id") % 4).cast("string").alias("channel"), F.floor(F.col("event_id") / 100).alias("batch_id"), F.col("event_id").alias("row_index"), row.alias("row_json"))

    writer = stream.row_stream(spark, f"{path}/in", source.schema).writeStream.foreachBatch(stream.load_batch(f"{path}/out", _EVENT, prepare=prepare))
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(**stream.trigger(available_now=True)).start().awaitTermination()
    return stream.loaded(spark, f"{path}/out").select("channel", "batch_id", "row_index")
