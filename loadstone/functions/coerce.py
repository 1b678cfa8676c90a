"""Coercion of untyped values, as column expressions.

Every function takes the value's text and its JSON kind (``string``,
``number``, ``boolean``, ``object``, ``array`` or ``null``) and gives a struct
``(value, code, reason)``: code 0004 if the kind does not fit the type, 0030 if
the text does not, null if all is well.  A null value is null without error.

There is no Python UDF.  A rule yields what it uses more than once and goes on
with the value it is given back, so nothing is computed twice.  Called as a
function it is one expression, in which such parts are bound by lambdas, which
Spark interprets; that is for values inside arrays and maps.  For columns there
is :func:`coerced`: each part is a column of a projection of its own, level by
level for all rules at once, so there is no lambda, methods stay small and all
is generated code.
"""

from __future__ import annotations

from collections.abc import Callable, Generator
from functools import cache, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_TYPE, BAD_VALUE = "0004", "0030"
DEFAULT_ZONE = "America/Los_Angeles"

#: Words for booleans, and the bounds of the epoch guess in seconds, ms, µs.
TRUE_WORDS = ("1", "yes", "y", "t", "true", "on")
FALSE_WORDS = ("0", "no", "n", "f", "false", "off")
YEARS_1000 = 31_536_000_000

_BLANKS = "".join(map(chr, range(33)))
_SHIFT = r"(?:[Zz]|[+-]\d{2}:\d{2}(?::\d{2})?)"
_DATE_TIME = rf"^(?:-(?!0000))?\d{{4}}-\d{{2}}-\d{{2}}(?:[Tt]\d{{2}}:\d{{2}}(?::\d{{2}}(?:\.\d{{0,9}})?)?(?:{_SHIFT}(?:\[[^\]]+\])?)?)?$"
_OFFSET = rf"(?:{_SHIFT}(?:\[[^\]]+\])?)?$"
_CYCLE = 146_097 * 86_400  # seconds of 400 years, after which the calendar repeats
_MOST_BYTES = 16 * 1024 * 1024
_TIME = r"^\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?:Z|z|[+-]\d{2}:\d{2})?$"
_INTEGER = r"^[+-]?\d+$"

Parts = Generator[Column, Column, Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    The fold of an empty list is its start, given to ``body`` at the end.  (The
    only item of a transformed list would do as well, but its type is worked out
    anew for each row, twice for each level of nesting.)
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda start, _: start, body)


def rule(parts: Callable[..., Parts]) -> Callable[..., Column]:
    """A rule as a function of columns; its generator of parts is ``.parts``."""

    @wraps(parts)
    def whole(*args, **kwargs) -> Column:
        steps = parts(*args, **kwargs)

        def go_on(value: Column | None) -> Column:
            try:
                part = steps.send(value)
            except StopIteration as end:
                return end.value
            return let(part, go_on)

        return go_on(None)

    whole.parts = parts
    return whole


def coerced(df: DataFrame, rules: dict[str, Parts], prefix: str = "_b") -> DataFrame:
    """df with a column per rule (``C.date.parts(text, kind)`` and so on)."""
    last, names = {}, []
    live = [(name, steps, None) for name, steps in rules.items()]
    while live:
        level, going = {}, []
        for name, steps, value in live:
            try:
                part = steps.send(value)
            except StopIteration as end:
                last[name] = end.value
                continue
            own = f"{prefix}{len(names) + len(level)}"
            level[own] = part
            going.append((name, steps, named(own)))
        if level:
            df = df.withColumns(level)
        names += level
        live = going
    return df.withColumns(last).drop(*names)


def trimmed(text: Column) -> Column:
    """Without blanks and control characters at the ends (F.trim keeps tabs)."""
    return F.btrim(text, F.lit(_BLANKS))


def named(name: str) -> Column:
    """A column whose name rules can see, so that they can be written as one text."""
    column = F.col(name)
    column.__dict__["_name_of"] = f"`{name}`"
    return column


def result(value: Column, kind: Column, kinds: tuple[str, ...], what: str, reason: Column | None = None) -> Column:
    """(value, code, reason): an error where a value of a fitting kind came to nothing."""
    v, k, r = (c.__dict__.get("_name_of") if c is not None else "" for c in (value, kind, reason))
    if v and k and r is not None:  # one call to the JVM
        given, fits = f"({k} IS NOT NULL AND {k} <> 'null')", f"{k} IN ({', '.join(repr(x) for x in kinds)})"
        wrong = f"({r or v} IS {'NOT ' if r else ''}NULL)"
        return F.expr(
            f"struct(CASE WHEN {given} AND {fits} AND NOT {wrong} THEN {v} END AS value, CASE WHEN {given} AND NOT {fits} THEN '{BAD_TYPE}' WHEN {given} AND {wrong} THEN '{BAD_VALUE}' END AS code, "
            f"CASE WHEN {given} AND NOT {fits} THEN concat('{what} cannot be made from ', {k}) WHEN {given} AND {wrong} THEN {r or repr(f'not a valid {what}')} END AS reason)"
        )
    given = kind.isNotNull() & (kind != "null")
    unfit = given & ~kind.isin(*kinds)
    wrong = given & (value.isNull() if reason is None else reason.isNotNull())
    told = F.when(unfit, F.concat(F.lit(f"{what} cannot be made from "), kind)).when(wrong, F.lit(f"not a valid {what}") if reason is None else reason)
    return F.struct(F.when(given & ~unfit & ~wrong, value).alias("value"), F.when(unfit, F.lit(BAD_TYPE)).when(wrong, F.lit(BAD_VALUE)).alias("code"), told.alias("reason"))


# --- booleans and numbers --------------------------------------------------


@rule
def boolean(text: Column, kind: Column) -> Parts:
    """COER1: twelve words, case-free and trimmed; numbers are true unless they are zero, however small."""
    word = yield F.lower(trimmed(text))
    from_text = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    value = yield F.when(kind == "boolean", word == "true").when(kind == "number", word.rlike("^[^e]*[1-9]")).otherwise(from_text)
    return result(value, kind, ("boolean", "number", "string"), "boolean")


@rule
def decimal(text: Column, kind: Column, precision: int = 38, scale: int = 0) -> Parts:
    """COER2, COER3: rounded half up to the scale first, then checked against the range."""
    return result((yield trimmed(text).try_cast(T.DecimalType(precision, scale))), kind, ("number", "string"), f"number({precision},{scale})")


@rule
def double(text: Column, kind: Column) -> Parts:
    """COER4: also nan, inf and -inf in any case."""
    return result((yield trimmed(text).try_cast("double")), kind, ("number", "string"), "double")


@rule
def float32(text: Column, kind: Column) -> Parts:
    """COER5: as double, then narrowed."""
    return result((yield trimmed(text).try_cast("double").cast("float")), kind, ("number", "string"), "float")


@rule
def integer(text: Column, kind: Column, to: str = "int") -> Parts:
    """COER6, COER7: one rounding half up to an integer, then the exact range of ``int`` or ``bigint``."""
    return result((yield trimmed(text).try_cast("decimal(38,0)").try_cast(to)), kind, ("number", "string"), to)


# --- text and bytes ----------------------------------------------------------


@rule
def plain_number(text: Column) -> Parts:
    """A number's text without exponent and needless zeros, of any length: the point is moved in the string of its digits."""
    form = r"^[\x00-\x20]*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,9}))?[\x00-\x20]*$"
    written = yield F.when(text.rlike(form) & text.rlike(r"[eE.]|^[+-]?0"), text)
    whole, part = F.regexp_extract(written, form, 2), F.regexp_extract(written, form, 3)
    scale = yield F.length(part) - F.coalesce(F.regexp_extract(written, form, 4).try_cast("int"), F.lit(0))
    all_digits = yield F.ltrim(F.concat(whole, part), F.lit("0"))
    digits = yield F.rtrim(all_digits, F.lit("0"))
    # digits behind the point, once zeros at the end are gone; more zeros than any string may have need not be written
    behind = yield F.greatest(F.least(scale - (F.length(all_digits) - F.length(digits)), F.lit(_MOST_BYTES + 1)), F.lit(-_MOST_BYTES - 1))
    zeros = lambda n: F.repeat(F.lit("0"), n)
    point = F.length(digits) - behind
    plain = (
        F.when(digits == "", F.lit("0")).when(behind <= 0, F.concat(digits, zeros(-behind)))
        .when(point > 0, F.concat_ws(".", F.substr(digits, F.lit(1), point), F.substr(digits, point + 1)))
        .otherwise(F.concat(F.lit("0."), zeros(-point), digits))
    )
    sign = F.when((F.regexp_extract(written, form, 1) == "-") & (digits != ""), F.lit("-")).otherwise(F.lit(""))
    return F.coalesce((yield F.when(written.isNotNull(), F.concat(sign, plain))), text)


@rule
def string(text: Column, kind: Column, max_chars: int | None = None, max_bytes: int = 16 * 1024 * 1024) -> Parts:
    """COER8, COER9, COER10: not trimmed; numbers plain; limits in code points and UTF-8 bytes."""
    plain = yield from plain_number.parts(F.when(kind == "number", text))
    value = yield F.when(kind == "number", plain).when(kind == "boolean", F.lower(text)).otherwise(text)
    reason = F.when(~F.is_valid_utf8(value), F.lit("not valid UTF-8")).when(F.octet_length(value) > max_bytes, F.lit(f"longer than {max_bytes} bytes"))
    if max_chars is not None:
        reason = reason.when(F.length(value) > max_chars, F.lit(f"longer than {max_chars} characters"))
    return result(value, kind, ("string", "number", "boolean"), "string", (yield reason))


@rule
def binary(text: Column, kind: Column, max_bytes: int = 8 * 1024 * 1024, exact_bytes: int | None = None) -> Parts:
    """COER11, COER12: hexadecimal with an even number of digits."""
    digits = yield trimmed(text)
    value = yield F.when(digits.rlike("^([0-9A-Fa-f]{2})*$"), F.unhex(digits))
    reason = F.when(value.isNull(), F.lit("not hexadecimal")).when(F.octet_length(value) > max_bytes, F.lit(f"longer than {max_bytes} bytes"))
    if exact_bytes is not None:
        reason = reason.when(F.octet_length(value) != exact_bytes, F.lit(f"not {exact_bytes} bytes long"))
    return result(value, kind, ("string",), "binary", (yield reason))


# --- dates and times ----------------------------------------------------------


@rule
def epoch_guess(text: Column) -> Parts:
    """COER17: (epoch_s, nanos) of an integer: seconds under a thousand years, else ms, µs, ns."""
    v = yield F.when(text.rlike(r"^[\x00-\x20]*[+-]?\d+[\x00-\x20]*$"), trimmed(text).try_cast("decimal(38,0)"))
    bound = lambda k: F.abs(v) < F.lit(YEARS_1000 * 10**k).cast("decimal(38,0)")
    # 10**9 parts of a unit: the whole seconds are what is left after the digits below them
    unit = yield F.when(bound(0), 0).when(bound(3), 3).when(bound(6), 6).otherwise(9)
    per = F.element_at(F.array(*[F.lit(10**k).cast("decimal(10,0)") for k in (0, 3, 6, 9)]), (unit / 3).cast("int") + 1)
    rest = yield F.pmod(v, per)
    seconds = ((v - rest).cast("decimal(28,0)") / per).cast("bigint")
    nanos = (rest * F.element_at(F.array(*[F.lit(10**k).cast("decimal(10,0)") for k in (9, 6, 3, 0)]), (unit / 3).cast("int") + 1)).cast("int")
    return (yield F.when(v.isNotNull(), F.struct(seconds.alias("epoch_s"), nanos.alias("nanos"))))


@cache
def zone_names() -> str:
    """Names of the regions that the JVM has rules for, as a list of SQL."""
    found = SparkSession.active()._jvm.java.time.ZoneId.getAvailableZoneIds()
    return ", ".join(f"'{name}'" for name in sorted({*found, "Z", "UT"}))


@rule
def instant(text: Column, zone: str = DEFAULT_ZONE) -> Parts:
    """COER16: struct (epoch_s, nanos, offset_min, local_s) of an ISO form or an integer; null if neither.

    Text with an offset is an instant; text without one is read in ``zone``.  A
    region in brackets follows an offset: the offset tells the instant, the region
    its wall clock.  Offsets go to 18:00, years from -9999.
    Wall clocks are kept as seconds of UTC, so the session's zone has no part
    in it, nor has a change of clocks.
    """
    s = yield trimmed(text)
    # without offset and region; null for other forms
    body = yield F.when(s.rlike(_DATE_TIME), F.regexp_replace(s, _OFFSET, ""))
    minus = F.startswith(body, F.lit("-"))
    head = yield F.upper(F.when(minus, F.substr(body, F.lit(2))).otherwise(body))
    tail = yield F.when(F.length(head) > 10, F.upper(F.substr(s, F.length(body) + 1, F.lit(9))))
    region = yield F.when(F.endswith(s, F.lit("]")) & body.isNotNull(), F.regexp_extract(s, r"\[([^\]]+)\]$", 1))
    written = F.substr(head, F.lit(1), F.lit(4)).cast("int")
    year = yield F.when(minus, -written).otherwise(written)
    # the same day of a year that casts can read
    like = (F.pmod(year, F.lit(400)) + 2000).cast("int")
    clock_text = F.when(F.length(head) == 10, "T00:00:00Z").when(F.length(head) == 16, F.concat(F.substr(head, F.lit(11)), F.lit(":00Z"))).otherwise(F.concat(F.substr(head, F.lit(11), F.lit(9)), F.lit("Z")))
    read = yield F.concat(like.cast("string"), F.substr(head, F.lit(5), F.lit(6)), clock_text).try_cast("timestamp")
    wall = yield F.unix_seconds(read) + F.floor((year - 2000) / 400) * _CYCLE
    nanos = F.when(F.length(head) > 20, F.rpad(F.substr(head, F.lit(21)), 9, "0").cast("int")).otherwise(0)
    part = lambda k: F.coalesce(F.substr(tail, F.lit(k), F.lit(2)).try_cast("int"), F.lit(0))
    seconds = yield F.when(F.substr(tail, F.lit(7), F.lit(1)) == ":", part(8)).otherwise(0)
    shift = yield F.when((part(5) < 60) & (seconds < 60), part(2) * 3600 + part(5) * 60 + seconds)
    sign, fits = F.substr(tail, F.lit(1), F.lit(1)), shift <= 18 * 3600
    without = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(wall), zone))
    epoch = yield F.when(sign == "Z", wall).when(sign == "+", F.when(fits, wall - shift)).when(sign == "-", F.when(fits, wall + shift)).otherwise(without)
    known = yield F.when(_in_zones(region), region)
    local = yield F.when(region.isNull(), F.when(epoch.isNotNull(), wall)).when(known.isNotNull(), F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(epoch), known)))
    stored = yield from epoch_guess.parts(F.when(body.isNull(), s))
    offset = ((local - epoch) / 60).cast("int")
    told = F.struct(epoch.alias("epoch_s"), nanos.alias("nanos"), offset.alias("offset_min"), local.alias("local_s"))
    counted = F.struct(stored["epoch_s"].alias("epoch_s"), stored["nanos"].alias("nanos"), F.lit(0).alias("offset_min"), stored["epoch_s"].alias("local_s"))
    return (yield F.when(local.isNotNull(), told).when(body.isNull() & stored.isNotNull(), counted))


def _in_zones(region: Column) -> Column:
    name = region.__dict__.get("_name_of")
    return F.expr(f"{name} IN ({zone_names()})") if name else F.array_contains(F.expr(f"array({zone_names()})"), region)


@rule
def date(text: Column, kind: Column) -> Parts:
    """COER13: the local date as written, in the region if one is named; integers in UTC; years -9999 to 9999."""
    found = yield from instant.parts(text, "UTC")
    day = yield F.floor(found["local_s"] / 86400)
    return result((yield F.when(day.between(-4371587, 2932896), F.date_from_unix_date(day.cast("int")))), kind, ("string",), "date")


@rule
def time(text: Column, kind: Column, scale: int = 9) -> Parts:
    """COER14: integer count of 10**-scale seconds since midnight, cut to the scale."""
    s = yield trimmed(text)
    clock = yield F.when(s.rlike(_TIME), F.upper(F.regexp_replace(s, _OFFSET, "")))
    h, m, sec = (F.coalesce(F.substr(clock, F.lit(k), F.lit(2)).try_cast("bigint"), F.lit(0)) for k in (1, 4, 7))
    seconds = yield F.when(clock.isNotNull() & (h < 24) & (m < 60) & (sec < 60), h * 3600 + m * 60 + sec)
    nanos = F.when(F.length(clock) > 9, F.rpad(F.substr(clock, F.lit(10)), 9, "0").cast("bigint")).otherwise(0)
    unit, per = 10**scale, 10 ** (9 - scale)
    guess = yield from epoch_guess.parts(F.when(clock.isNull(), s))
    stored = F.pmod(guess["epoch_s"], F.lit(86400)) * unit + F.floor(guess["nanos"] / per)
    value = yield F.when(clock.isNotNull(), seconds * unit + F.floor(nanos / per)).otherwise(stored).cast("bigint")
    return result(value, kind, ("string",), "time")


@rule
def timestamp(text: Column, kind: Column, logical: str = "TIMESTAMP_NTZ", scale: int = 6, zone: str = DEFAULT_ZONE) -> Parts:
    """COER15: NTZ keeps the wall clock and drops the offset; LTZ is the instant;
    TZ, and any scale over 6, is struct (epoch_s, nanos, offset_min)."""
    per = 10 ** (9 - scale)
    found = yield from instant.parts(text, zone)
    seconds = yield found["local_s"] if logical == "TIMESTAMP_NTZ" else found["epoch_s"]
    nanos = F.floor(found["nanos"] / per) * per
    if scale > 6 or logical == "TIMESTAMP_TZ":
        offset = found["offset_min"] if logical == "TIMESTAMP_TZ" else F.lit(0)
        value = F.struct(seconds.alias("epoch_s"), nanos.cast("int").alias("nanos"), offset.alias("offset_min"))
    elif logical == "TIMESTAMP_NTZ":
        value = ntz(seconds, nanos)
    else:
        value = F.timestamp_micros(seconds * 1_000_000 + F.floor(nanos / 1000))
    return result((yield F.when(seconds.between(-62135596800, 253402300799), value)), kind, ("string",), logical.lower())


def ntz(seconds: Column, nanos: Column) -> Column:
    """The wall clock so many seconds after 1970, whatever the session's zone."""
    day = F.floor(seconds / 86400)
    rest = (seconds - day * 86400).cast("decimal(18,6)") + (F.floor(nanos / 1000).cast("decimal(18,6)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(days=day.cast("int"), secs=rest.cast("decimal(18,6)"))


def scaled_timestamp(epoch_s: Column, nanos: Column, scale: int) -> Column:
    """COER18: the integer that a timestamp of this scale is kept as."""
    return (epoch_s.cast("decimal(38,0)") * F.lit(10**scale).cast("decimal(10,0)") + F.floor(nanos / 10 ** (9 - scale))).cast("decimal(38,0)")


def zoned_timestamp(epoch_s: Column, nanos: Column, offset_min: Column, scale: int) -> Column:
    """COER19: the scaled integer times 2**14, plus offset minutes + 1440."""
    return (scaled_timestamp(epoch_s, nanos, scale).cast("decimal(28,0)") * F.lit(16384) + offset_min + 1440).cast("decimal(38,0)")


# --- semi-structured -----------------------------------------------------------


def minified(text: Column) -> Column:
    """Blanks outside strings dropped; number spelling kept."""
    return F.regexp_replace(text, r'("(?:\\.|[^"\\])*")|\s+', "$1")


def _json_reason(text: Column, small: Column, limit: int) -> Column:
    """Why a text, minified to ``small``, is not one JSON value.  Keys are compared without trailing
    NULs: they are taken off and the text, which must have no equal keys, is
    parsed again."""
    no_nul = F.regexp_replace(text, r'(?<!\\)((?:\\\\)*)(?:\\u0000)+"(\s*:)', '$1"$2')
    valid = F.try_parse_json(text).isNotNull() & (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1)
    return (
        F.when(F.coalesce(~valid, F.lit(True)), F.lit("not one JSON value without repeated keys"))
        .when(F.contains(text, F.lit("\\u0000")) & F.try_parse_json(no_nul).isNull(), F.lit("repeated keys"))
        .when(F.octet_length(small) > limit, F.lit(f"longer than {limit} bytes"))
    )


_ALL = ("string", "number", "boolean", "object", "array")


@rule
def variant(text: Column, kind: Column, limit: int = 16 * 1024 * 1024 - 64) -> Parts:
    """COER20, COER23: minified JSON text; empty and blank are null."""
    small = yield minified(text)
    blank = small == ""
    reason = yield F.when(blank, None).otherwise(_json_reason(text, small, limit))
    return result(F.when(~blank, small), kind, _ALL, "variant", reason)


@rule
def array(text: Column, kind: Column, limit: int = 16 * 1024 * 1024 - 64) -> Parts:
    """COER21: a value that is no array becomes one of itself; empty is ``[null]``."""
    small = yield minified(text)
    filled = F.when(small == "", F.lit("null")).otherwise(small)
    wrapped = F.when(F.startswith(filled, F.lit("[")), filled).otherwise(F.concat(F.lit("["), filled, F.lit("]")))
    return result(wrapped, kind, _ALL, "array", (yield _json_reason(F.when(small == "", F.lit("null")).otherwise(text), filled, limit)))


@rule
def object_(text: Column, kind: Column, limit: int = 16 * 1024 * 1024 - 64) -> Parts:
    """COER22: an object, or an error."""
    small = yield minified(text)
    reason = yield F.when(~F.startswith(small, F.lit("{")), F.lit("not an object")).otherwise(_json_reason(text, small, limit))
    return result(small, kind, _ALL, "object", reason)


def typed_json(column: Column, kind: T.DataType) -> Column:
    """COER24: JSON text of a typed column: bytes as number arrays, date-times in ISO form."""
    whole = F.to_json(F.struct(_json_ready(column, kind).alias("v")), {"ignoreNullFields": "false"})
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


def _json_ready(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        hexed = F.hex(column)
        byte = lambda i: F.conv(F.substr(hexed, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        signed = F.transform(F.sequence(F.lit(0), F.octet_length(column) - 1), lambda i: F.when(byte(i) > 127, byte(i) - 256).otherwise(byte(i)))
        return F.when(F.octet_length(column) > 0, signed).when(column.isNotNull(), F.array().cast("array<int>"))
    if isinstance(kind, T.StructType):
        return F.when(column.isNotNull(), F.struct(*[_json_ready(column[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _json_ready(x, kind.elementType))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("map keys must be strings")
        return F.transform_values(column, lambda _, v: _json_ready(v, kind.valueType))
    return column


# --- by field --------------------------------------------------------------------


@rule
def coerce(field: T.StructField, text: Column, kind: Column, zone: str = DEFAULT_ZONE) -> Parts:
    """(value, code, reason) of a value for a column of a table."""
    t, m = field.dataType, field.metadata
    if semi := m.get("semi_structured"):
        return (yield from {"VARIANT": variant, "ARRAY": array, "OBJECT": object_}[semi].parts(text, kind))
    if m.get("logical") in ("TIMESTAMP_NTZ", "TIMESTAMP_LTZ", "TIMESTAMP_TZ"):
        return (yield from timestamp.parts(text, kind, m["logical"], m["ts_scale"], zone))
    if "time_scale" in m:
        return (yield from time.parts(text, kind, m["time_scale"]))
    if isinstance(t, T.BooleanType):
        return (yield from boolean.parts(text, kind))
    if isinstance(t, T.DecimalType):
        return (yield from decimal.parts(text, kind, t.precision, t.scale))
    if isinstance(t, T.DoubleType):
        return (yield from double.parts(text, kind))
    if isinstance(t, T.FloatType):
        return (yield from float32.parts(text, kind))
    if isinstance(t, (T.IntegerType, T.LongType)):
        return (yield from integer.parts(text, kind, t.simpleString()))
    if isinstance(t, T.StringType):
        return (yield from string.parts(text, kind, m.get("max_chars"), m.get("max_bytes", 16 * 1024 * 1024)))
    if isinstance(t, T.BinaryType):
        return (yield from binary.parts(text, kind, m.get("max_bytes", 8 * 1024 * 1024), m.get("exact_bytes")))
    if isinstance(t, T.DateType):
        return (yield from date.parts(text, kind))
    if isinstance(t, T.TimestampNTZType):
        return (yield from timestamp.parts(text, kind, "TIMESTAMP_NTZ", 6, zone))
    if isinstance(t, T.TimestampType):
        return (yield from timestamp.parts(text, kind, "TIMESTAMP_LTZ", 6, zone))
    raise TypeError(f"no coercion to {t.simpleString()}")
