"""Coercion rules by value tables: accepted forms, exact results, error codes."""

import datetime as dt
import json
from decimal import Decimal, localcontext
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from loadstone.functions import coerce as C
from loadstone.plans.schema import UnsupportedSchema, dot_path, iceberg_type, leaves, table_schema, unquote

OK, BAD, TYPE = None, "0030", "0004"


def run(spark, rule, values, kind="string", *more):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    args = (F.col("t"), F.lit(kind), *more)
    one = df.select("i", rule(*args).alias("r")).orderBy("i").collect()
    parts = C.coerced(df, {"r": rule.parts(*args)}).select("i", "r").orderBy("i").collect()
    assert one == parts or "nan" in str(one).lower()  # as one expression and by parts
    return [(r.r.value, r.r.code) for r in parts]


#: Accepted and refused forms with their results.
CASES = {
    "boolean": (C.boolean, {**dict.fromkeys(["TruE", "t", "YeS", "y", "on", "1", " true\t"], True), **dict.fromkeys(["FalsE", "f", "NO", "n", "off", "0"], False), "foobar": BAD, "": BAD, "1.1": BAD, "-10": BAD, "2.5": BAD, "00": BAD}),
    "decimal": ((C.decimal, 38, 2), {"1e3": Decimal("1000.00"), "1.23e2": Decimal("123.00"), "2.345": Decimal("2.35"), "-2.345": Decimal("-2.35"), "honk": BAD, "0x22": BAD, "NaN": BAD}),
    "decimal range": ((C.decimal, 3, 1), {"99.94": Decimal("99.9"), "99.95": BAD, "-99.9": Decimal("-99.9")}),
    "int": (C.integer, {"0.5": 1, "-0.5": -1, "1.0e-1": 0, "2147483647.499": 2147483647, "2147483647.5": BAD, "NaN": BAD, "Inf": BAD, "0." + "4" + "9" * 40: 0}),
    "long": ((C.integer, "bigint"), {"9223372036854775807": 9223372036854775807, "9223372036854775808": BAD}),
    "double": (C.double, {"inF": float("inf"), " -inF \t\n": float("-inf"), "1.23e2": 123.0, "foo": BAD}),
    "string": ((C.string, 1), {"a": "a", "č": "č", "❄": "❄", "🍞": "🍞", "a🍞": BAD, " ": " "}),
    "string bytes": ((C.string, None, 4), {"abcd": "abcd", "🍞": "🍞", "🍞a": BAD}),
    "date": (C.date, {"1967-06-23": dt.date(1967, 6, 23), "  1967-06-23 \t\n": dt.date(1967, 6, 23), "2020-07-21T23:31:00-07:00": dt.date(2020, 7, 21), "2020-07-21T23:31:00+09:00[Asia/Tokyo]": dt.date(2020, 7, 21), "1674478926": dt.date(2023, 1, 23), "1674478926000": dt.date(2023, 1, 23), "20:57:01": BAD, "1.0": BAD, "": BAD, "2023-02-30": BAD}),
    "time 0": ((C.time, 0), {"13:02": 46920, "13:02:06": 46926, "2023-01-19": BAD, "25:00": BAD}),
    "time 1": ((C.time, 1), {"13:02:06.1234": 469261, "1674478926123": 469261}),
    "time 9": (C.time, {"13:02:06.123456789-09:00": 46926123456789, "13:02:06.1": 46926100000000}),
    "ntz": (C.timestamp, {"2021-01-01T01:00:00.123+01:00": dt.datetime(2021, 1, 1, 1, 0, 0, 123000), "2021-07-01": dt.datetime(2021, 7, 1), "31536000001": dt.datetime(1971, 1, 1, 0, 0, 0, 1000), "2021-01-01 01:00": BAD, "x": BAD}),
    "tz": ((C.timestamp, "TIMESTAMP_TZ", 4), {"2021-01-01T01:00:00.123+01:00": (1609459200, 123000000, 60), "2021-07-01": (1625122800, 0, -420), "31535999999999": (31535999999, 999000000, 0)}),
    "variant": (C.variant, {' { "key": 1 } ': '{"key":1}', "11.111111111111E-8": "11.111111111111E-8", "": None, "  ": None, "{null}": BAD, "}{": BAD, "foo": BAD, '{"key":1, "key":2}': BAD, '{"a":{"k":1,"k":2}}': BAD, '[{"a":1,"a":2}]': BAD, '{"a":1,"a\\u0000":2}': BAD, '{"a":"x\\u0000","b":1}': '{"a":"x\\u0000","b":1}', "1 2": BAD}),
    "array": (C.array, {"1": "[1]", " 1.1e10 ": "[1.1e10]", "": "[null]", "null": "[null]", "[1, 2]": "[1,2]", "[": BAD}),
    "object": (C.object_, {" { } ": "{}", "1": BAD, "[1]": BAD}),
}


@pytest.mark.parametrize("name", CASES)
def test_values(spark, name):
    rule, cases = CASES[name]
    rule, *more = rule if isinstance(rule, tuple) else (rule,)
    for (value, code), (text, expected) in zip(run(spark, rule, list(cases), "string", *more), cases.items(), strict=True):
        if expected in (BAD, TYPE) and isinstance(expected, str) and expected.startswith("00"):
            assert (value, code) == (None, expected), text
        else:
            assert code is None, text
            assert (tuple(value) if isinstance(expected, tuple) else value) == expected, text


def test_numbers_as_booleans(spark):
    assert run(spark, C.boolean, ["1.1", "-10", "0", "0.0", "0e5", "1e-400", "-0.00", "1E5"], "number") == [(True, OK), (True, OK), (False, OK), (False, OK), (False, OK), (True, OK), (False, OK), (True, OK)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Australia/Lord_Howe"])
def test_wall_clocks_do_not_depend_on_the_session_zone(spark, zone):
    """In the hour that clocks repeat or leave out, and far from it."""
    texts = ["2023-11-05T01:30:00", "2023-11-05T09:30:00", "2023-03-12T02:30:00", "2023-03-12T10:30:00.123456789", "2023-10-01T02:15:00Z", "2023-04-02T01:45:00-07:00", "1900-01-01", "0001-01-01T00:00", "9999-12-31T23:59:59.999999"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        rules = {"ntz": C.timestamp.parts(F.col("t"), F.lit("string"), "TIMESTAMP_NTZ", 6, "America/Los_Angeles"), "tz": C.timestamp.parts(F.col("t"), F.lit("string"), "TIMESTAMP_TZ", 9, "America/Los_Angeles"), "ltz": C.timestamp.parts(F.col("t"), F.lit("string"), "TIMESTAMP_LTZ", 6, "America/Los_Angeles")}
        got = C.coerced(df, rules).select("i", F.col("ntz.value").cast("string").alias("ntz"), "tz.value", F.unix_micros("ltz.value").alias("us")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    walls = [(t[:26] if "T" in t and len(t) > 19 and t[19] == "." else t[:19]).replace("T", " ") for t in texts]
    walls = [w + " 00:00:00" if len(w) == 10 else w + ":00" if len(w) == 16 else w for w in walls]
    assert [r.ntz for r in got] == walls
    assert [r.value.epoch_s for r in got[:6]] == [1699173000, 1699205400, 1678617000, 1678642200, 1696126500, 1680425100]
    assert all(r.us == r.value.epoch_s * 10**6 + r.value.nanos // 1000 for r in got[:-1])
    assert got[-1].value is None and got[-1].us is None  # in the given zone that is after the year 9999 in UTC


def test_binary(spark):
    got = run(spark, C.binary, ["ab12", " 00 ", "", "abc", "zz", "aabbcc"], "string", 2)
    assert [(bytes(v) if v is not None else None, c) for v, c in got] == [(b"\xab\x12", None), (b"\0", None), (b"", None), (None, BAD), (None, BAD), (None, BAD)]
    assert run(spark, C.binary, ["aabb"], "string", 9, 3)[0][1] == BAD


def test_kinds(spark):
    assert run(spark, C.decimal, ["true"], "boolean") == [(None, TYPE)]
    assert run(spark, C.date, ["1"], "number") == [(None, TYPE)]
    assert run(spark, C.string, ["{}"], "object") == [(None, TYPE)]
    assert run(spark, C.string, ["1.10", "1e3", "100", "1.5e-3"], "number") == [("1.1", None), ("1000", None), ("100", None), ("0.0015", None)]
    assert run(spark, C.integer, [None], "null") == [(None, None)]


def test_plain_numbers_of_any_length(spark):
    texts = ["1e-20", "1e40", "1." + "0" * 22 + "1", "-0.5e-3", "123.4500e2", "0.000", "-0", "1.10E+5", "0e9", "7", "-12.", "1e-30", "9" * 45 + ".50", "0012.0"]
    got = run(spark, C.string, texts, "number")
    with localcontext() as ctx:
        ctx.prec = 100
        plain = [format(Decimal(t).normalize(), "f") if Decimal(t) else "0" for t in texts]
    assert got == [(p, None) for p in plain]
    assert run(spark, C.string, ["1e99999999", "1e-99999999"], "number") == [(None, BAD)] * 2


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Australia/Lord_Howe"])
def test_regions_offsets_and_years(spark, zone):
    """An offset tells the instant, a region its wall clock; at both changes of clocks too."""
    regions = ["Europe/Paris", "America/Los_Angeles", "Asia/Tokyo", "Australia/Lord_Howe", "UTC", "Asia/Kathmandu"]
    walls = ["2020-01-01T13:45:10", "2021-07-01T00:00", "2023-03-26T02:30:00", "2023-10-29T02:30:00.5", "2023-11-05T01:30:00", "1969-12-31T23:59:59"]
    offsets = ["+01:00", "-07:00", "Z", "+09:30", "-08:00", "+18:00", "-00:30"]
    texts = [f"{w}{o}[{r}]" for w in walls for o in offsets for r in regions]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        rules = {"ntz": C.timestamp.parts(F.col("t"), F.lit("string"), "TIMESTAMP_NTZ", 6), "tz": C.timestamp.parts(F.col("t"), F.lit("string"), "TIMESTAMP_TZ", 9), "day": C.date.parts(F.col("t"), F.lit("string"))}
        got = C.coerced(df, rules).select("t", F.col("ntz.value").cast("string").alias("ntz"), "tz.value", F.col("day.value").cast("string").alias("day")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for r in got:
        text, region = r.t[:-1].split("[")
        at = dt.datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(ZoneInfo(region))
        assert r.ntz == at.strftime("%Y-%m-%d %H:%M:%S") + (".5" if at.microsecond else ""), r.t
        assert (r.value.epoch_s, r.value.nanos) == (int((at.replace(microsecond=0) - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)).total_seconds()), at.microsecond * 1000), r.t
        assert r.value.offset_min == at.utcoffset().total_seconds() // 60 and r.day == at.strftime("%Y-%m-%d"), r.t


def test_date_time_forms(spark):
    bad = ["2020-01-01T13:45:10[Europe/Paris]", "2020-01-01T13:45:10+01:00[no zone]", "2020-01-01T13:45:10+01:00[nonsense]", "2020-01-01T13:45:10+01:00[europe/paris]", "2020-01-01T13:45:10+19:00", "2020-01-01T13:45:10+18:01",
           "2020-01-01T13:45:10+01:60", "2020-01-01[Europe/Paris]", "2020-01-01Z", "+2020-01-01", "-0000-01-01", "12020-01-01", "2023-02-29", "-0001-02-29", "2020-01-01T24:00", "2020-01-01T13:45:60", "2020-01-01T13"]
    assert run(spark, C.date, bad) == [(None, BAD)] * len(bad)
    good = {"-0001-01-01": -719893, "-9999-12-31": -4371223, "0000-02-29": -719469, "0001-01-01": -719162, "9999-12-31": 2932896, "-0004-02-29": -720930, "2020-02-29T23:59:59-18:00": 18321, "2020-01-01T10:00:00.+01:00:30": 18262}
    df = C.coerced(spark.createDataFrame([(i, t) for i, t in enumerate(good)], "i int, t string"), {"r": C.date.parts(F.col("t"), F.lit("string"))})
    assert [r[0] for r in df.orderBy("i").select(F.unix_date("r.value")).collect()] == list(good.values())
    assert run(spark, C.timestamp, ["-0001-01-01", "0000-06-01T00:00", "0001-01-01"], "string", "TIMESTAMP_NTZ", 6)[:2] == [(None, BAD)] * 2


def test_scaled_timestamps(spark):
    row = spark.range(1).select(C.scaled_timestamp(F.lit(1609459200), F.lit(123456789), 4).alias("a"), C.zoned_timestamp(F.lit(1609459200), F.lit(123000000), F.lit(60), 4).alias("b")).first()
    assert int(row.a) == 16094592001234
    assert int(row.b) == 16094592001230 * 2**14 + 1500


def test_typed_json(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\xff"), {"a": 1}, [1, None])], "b binary, m map<string,int>, l array<int>")
    got = df.select(*[C.typed_json(F.col(f.name), f.dataType) for f in df.schema.fields]).first()
    assert list(map(json.loads, got)) == [[1, -1], {"a": 1}, [1, None]]


def test_names_and_schemas():
    assert [unquote(x) for x in ("abc", '"aBc"', '"a""b"', "c\\ 5", '"a"b"')] == ["ABC", "aBc", 'a"b', "C 5", '"A"B"']
    assert dot_path("a.b", "c\\d") == "a\\.b.c\\\\d"
    for bad in ({"name": "x", "logicalType": "GEOGRAPHY"}, {"name": "x", "logicalType": "TEXT", "collation": "en"}, {"name": "x", "logicalType": "TIME", "physicalType": "SB16"}):
        with pytest.raises(UnsupportedSchema):
            table_schema([bad])
    nested = table_schema([{"name": "V", "sourceIcebergDataType": json.dumps({"type": "struct", "fields": [{"id": 2, "name": "a", "required": True, "type": "int"}, {"id": 3, "name": "l", "type": {"type": "list", "element": "string"}}]})}])
    assert [(x.path, x.field_id, x.repeated) for x in leaves(nested)] == [("V.a", 2, False), ("V.l.list.element", 3, True)]
    assert iceberg_type("decimal(9,2)").simpleString() == "decimal(9,2)"
