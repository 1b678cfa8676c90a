"""Row conformance: untyped rows to typed rows, errors and a batch report.

``conform`` is one declarative job.  The checks of a row run in a fixed order
and only the first failing group is reported: extra columns, missing required
columns, nulls in required columns, value errors (all of a row), row size.
The policy of a batch then decides what becomes of its rows:

* ``continue``   keep good rows, report every bad one;
* ``abort``      drop a batch with a bad row, report its first (``raise_on_abort`` raises);
* ``skip_batch`` drop a batch with a bad row, report all of its bad ones.

Without a per-channel policy no shuffle is needed for ``continue``; for the
others only the keys of batches with errors are joined back.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.functions import coerce as C
from loadstone.plans.schema import dot_path

KEYS = ("table", "channel", "batch_id")
MAX_ROW_BYTES = 64 * 1024 * 1024
BATCH_WARNING = 16 * 1024 * 1024
GROUP = 6  # columns that are coerced in one run of projections
MANY = 48  # columns of a table up to which they are coerced by such groups, beyond all in one run: plans must not grow deep
WIDE = 160  # columns of a table up to which each is coerced by expressions of its own
CONTINUE, ABORT, SKIP_BATCH = "continue", "abort", "skip_batch"

ERROR_TYPE = "struct<code: string, message: string, extra_columns: array<string>, missing_not_null: array<string>, null_not_null: array<string>>"
_NO_NAMES = "array<string>"


class Conformed(NamedTuple):
    good: DataFrame
    errors: DataFrame
    report: DataFrame


class BatchAborted(ValueError):
    """Raised for the first bad row of an ABORT batch."""


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns added, each computed once.

    Filters above are not folded into these expressions, as they would be
    through a plain projection: the generator of one row is a border for the
    rule, and has generated code.
    """
    keep = [c for c in df.columns if c not in columns]
    return df.withColumns(columns).select(*keep, F.inline(F.array(F.struct(*columns))))


SPLIT = 4 * 1024 * 1024  # bytes; files are not cut smaller for one task
NESTED_SPLIT = 128 * 1024  # bytes that one task takes of rows with nested columns; packed files hold some 200 rows a KB
MOST_TASKS = 20_000  # to which rows are dealt
UNKNOWN = 1 << 60  # bytes, from which the planner's size stands for none


def spread(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows dealt out over all cores where the planner finds them too few bytes to be read by as many tasks.

    Checking a row costs far more than moving it, and so little is soon moved;
    larger inputs, and those of unknown size, are left as they are read.  Rules of
    nested columns are interpreted, some tenths of a millisecond a row, so such rows
    are dealt out at any known size, to more tasks of a larger input.
    """
    if raw.isStreaming:
        return raw
    cores = raw.sparkSession.sparkContext.defaultParallelism
    size = int(raw._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size < UNKNOWN and any(is_nested(f) for f in schema.fields):
        return raw.repartition(max(cores, min(-(-size // NESTED_SPLIT), MOST_TASKS)))
    return raw.repartition(cores) if size < cores * SPLIT else raw


def unquote_name(name: Column) -> Column:
    """CONF1: outer quotes off and doubled ones single; otherwise ``\\ `` to a space, upper case."""
    inner = F.replace(F.substr(name, F.lit(2), F.length(name) - 2), F.lit('""'), F.lit('"'))
    return F.when(name.rlike(r'(?s)^"(?:""|[^"])*"$'), inner).otherwise(F.upper(F.replace(name, F.lit("\\ "), F.lit(" "))))


def kind_named(s: Column) -> Column:
    """JSON kind of a variant value by its schema, which is null for no value."""
    return (
        F.when(s == "STRING", "string").when(s.isNull() | (s == "VOID"), "null").when(s == "BOOLEAN", "boolean")
        .when(F.startswith(s, F.lit("OBJECT")), "object").when(F.startswith(s, F.lit("ARRAY")), "array").otherwise("number")
    )


_KIND = "CASE WHEN {s} = 'STRING' THEN 'string' WHEN {s} IS NULL OR {s} = 'VOID' THEN 'null' WHEN {s} = 'BOOLEAN' THEN 'boolean' WHEN startswith({s}, 'OBJECT') THEN 'object' WHEN startswith({s}, 'ARRAY') THEN 'array' ELSE 'number' END"


def parsed_rows(raw: DataFrame, row: str = "row_json") -> DataFrame:
    """SRC5: adds ``_keys`` (names as written), ``_names`` (normalised), ``_values`` (texts), all in
    one order, and ``_fields`` (variants by name as written; null for rows of maps).

    A JSON row keeps the spelling of numbers and nested values; a
    ``map<string,string>`` row has only strings.  ``_names`` is null for what is
    not an object of unique names.
    """
    if isinstance(raw.schema[row].dataType, T.MapType):
        raw = raw.withColumns({"_texts": F.col(row), "_fields": F.lit(None).cast("map<string,string>")})
        told = F.col("_texts").isNotNull()
    else:
        raw = raw.withColumns({"_texts": F.from_json(F.col(row), "map<string,string>"), "_fields": F.expr(f"try_cast(try_parse_json(`{row}`) AS map<string,variant>)")})
        told = F.col("_fields").isNotNull() & F.col("_texts").isNotNull()
    raw = raw.withColumns({"_keys": F.when(told, F.map_keys("_texts")), "_values": F.map_values("_texts")})
    return raw.withColumn("_names", F.transform("_keys", unquote_name)).drop("_texts")


def found_values(rows: DataFrame, schema: T.StructType, row: str = "row_json") -> DataFrame:
    """Adds, for column i of the schema, ``_t{i}`` (text), ``_k{i}`` (kind; null
    if the row has no such name) and ``_v{i}`` (variant, for nested columns).
    Of two spellings of one name the last wins."""
    fields = list(enumerate(schema.fields))
    rows = rows.withColumn("_back", F.reverse("_names"))
    rows = rows.withColumns({f"_p{i}": F.expr(f"size(_back) - int(array_position(_back, {sql_text(f.name)}))") for i, f in fields})
    at = lambda column, i: F.expr(f"get({column}, _p{i})")  # noqa: E731  # null beyond the end
    texts = {f"_t{i}": at("_values", i) for i, _ in fields}
    if isinstance(rows.schema[row].dataType, T.MapType):
        rows = rows.withColumns(texts)
        kinds = {f"_k{i}": F.when(F.col(f"_p{i}") < F.size("_names"), F.when(F.col(f"_t{i}").isNull(), "null").otherwise("string")) for i, _ in fields}
        kinds |= {f"_v{i}": F.coalesce(F.try_parse_json(F.col(f"_t{i}")), F.col(f"_t{i}").cast("variant")) for i, f in fields if is_nested(f)}
        return rows.withColumns(kinds).drop("_back", *[f"_p{i}" for i, _ in fields])
    rows = rows.withColumns(texts | {f"_v{i}": F.expr(f"try_element_at(_fields, get(_keys, _p{i}))") for i, _ in fields})
    rows = rows.withColumns({f"_s{i}": F.expr(f"schema_of_variant(_v{i})") for i, _ in fields})
    rows = rows.withColumns({f"_k{i}": F.expr(f"CASE WHEN _p{i} < size(_names) THEN {_KIND.format(s=f'_s{i}')} END") for i, _ in fields})
    return rows.drop("_back", *[f"{c}{i}" for i, _ in fields for c in ("_p", "_s")])


# --- nested columns ---------------------------------------------------------------


def _named(code: str, what: str, path: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(what).alias("what"), path.alias("path"))


_NO_ERRORS = "array<struct<code: string, what: string, path: string>>"


def relaxed(kind: T.DataType) -> T.DataType:
    """The type with null allowed everywhere: errors are told, not thrown."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, relaxed(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(relaxed(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(relaxed(kind.keyType), relaxed(kind.valueType), True)
    return kind


def nested(v: Column, kind: T.DataType, path: Column, nullable: bool, zone: str, metadata: dict | None = None) -> Column:
    """CONF8, COER25: struct (value, errors) of a variant for a nested type.  Extra,
    missing and null fields of all levels are gathered, with their dot paths.
    Each level is computed once, whatever lies below it."""
    none = F.array().cast(_NO_ERRORS)
    is_null = v.isNull() | F.is_variant_null(v)
    null_error = none if nullable else F.array(_named(C.BAD_TYPE, "null", path))
    join = lambda name: F.concat(path, F.lit("." + dot_path(name)))

    def told(value: Column, has_shape: Column, shape: str, errors: Column) -> Column:
        errors = F.when(is_null, null_error).when(~has_shape, F.array(_named(C.BAD_TYPE, shape, path))).otherwise(errors)
        return F.struct(F.when(~is_null, value).cast(relaxed(kind)).alias("value"), errors.alias("errors"))

    if isinstance(kind, T.StructType) and not (metadata or {}).get("ts_scale"):
        names, required = [f.name for f in kind.fields], [f.name for f in kind.fields if not f.nullable]
        escaped = lambda k: F.replace(F.replace(k, F.lit("\\"), F.lit("\\\\")), F.lit("."), F.lit("\\."))

        def with_fields(fields: Column) -> Column:
            keys = F.map_keys(fields)
            wrong = [F.transform(F.array_except(keys, F.array(*map(F.lit, names))), lambda k: _named(C.BAD_TYPE, "extra", F.concat(path, F.lit("."), escaped(k))))]
            if required:
                wrong.append(F.transform(F.array_except(F.array(*map(F.lit, required)), keys), lambda k: _named(C.BAD_TYPE, "missing", F.concat(path, F.lit("."), escaped(k)))))
            below = F.struct(*[nested(fields[f.name], f.dataType, join(f.name), f.nullable, zone, f.metadata).alias(f"f{i}") for i, f in enumerate(kind.fields)])

            def gathered(b: Column) -> Column:
                value = F.struct(*[b[f"f{i}"]["value"].alias(f.name) for i, f in enumerate(kind.fields)])
                errors = F.concat(*wrong, *[F.when(F.map_contains_key(fields, f.name), b[f"f{i}"]["errors"]).otherwise(none) for i, f in enumerate(kind.fields)])
                return told(F.when(fields.isNotNull(), value), fields.isNotNull(), "not a struct", errors)

            return C.let(below, gathered)

        return C.let(F.try_variant_get(v, "$", "map<string,variant>"), with_fields)
    if isinstance(kind, T.ArrayType):
        below_path = F.concat(path, F.lit(".list.element"))
        pairs = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: nested(x, kind.elementType, below_path, kind.containsNull, zone))
        return C.let(pairs, lambda ps: told(F.transform(ps, lambda p: p["value"]), ps.isNotNull(), "not a list", F.flatten(F.transform(ps, lambda p: p["errors"]))))
    if isinstance(kind, T.MapType):
        value_path, key_path = F.concat(path, F.lit(".key_value.value")), F.concat(path, F.lit(".key_value.key"))
        entry = lambda e: F.struct(C.coerce(T.StructField("key", kind.keyType), e["key"], F.lit("string"), zone).alias("k"), nested(e["value"], kind.valueType, value_path, kind.valueContainsNull, zone).alias("v"))
        pairs = F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), entry)
        of_key = lambda k: F.when(k["code"].isNotNull(), F.array(F.struct(k["code"].alias("code"), k["reason"].alias("what"), key_path.alias("path")))).otherwise(none)

        def with_entries(ps: Column) -> Column:
            held = F.filter(ps, lambda p: p["k"]["value"].isNotNull())
            value = F.map_from_arrays(F.transform(held, lambda p: p["k"]["value"]), F.transform(held, lambda p: p["v"]["value"]))
            return told(value, ps.isNotNull(), "not a map", F.flatten(F.transform(ps, lambda p: F.concat(p["v"]["errors"], of_key(p["k"])))))

        return C.let(pairs, with_entries)
    wrong = lambda o: F.when(o["code"].isNotNull(), F.array(F.struct(o["code"].alias("code"), o["reason"].alias("what"), path.alias("path")))).otherwise(none)
    rule = lambda text, k: C.coerce(T.StructField("x", kind, True, metadata or {}), text, k, zone)
    # rules use the text and its kind many times over: both are bound
    one = C.let(F.when(v.isNotNull(), F.schema_of_variant(v)), lambda s: C.let(kind_named(s), lambda k: C.let(F.try_variant_get(v, "$", "string"), lambda text: rule(text, k))))
    return C.let(one, lambda o: F.struct(o["value"].cast(kind).alias("value"), F.when(is_null, null_error).otherwise(wrong(o)).alias("errors")))


def is_nested(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.ArrayType, T.MapType)) or (isinstance(field.dataType, T.StructType) and "ts_scale" not in field.metadata)


# --- rows --------------------------------------------------------------------------


def sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def row_bytes(schema: T.StructType, columns: dict[str, str]) -> Column:
    """CONF9: estimated size: a quarter byte a value, fixed sizes by type, 4 + length for text and bytes.

    ``columns`` are the names of the columns that hold each field; written as
    SQL, which is one call to the JVM however wide the table is.
    """
    sizes = [sized(f, f"`{columns[f.name]}`") for f in schema.fields]
    return F.ceil(F.expr(" + ".join(sizes))) if sizes else F.lit(0).cast("long")


def sized(f: T.StructField, c: str) -> str:
    """CONF9 of one value, as SQL."""
    t = f.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        size = f"octet_length({c}) + 4.0D"
    elif isinstance(t, T.BooleanType):
        size = "0.125D"
    elif isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        size = "4.0D"
    elif isinstance(t, T.DecimalType):
        size = "16.0D" if t.scale or t.precision > 18 else "8.0D" if t.precision > 9 else "4.0D"
    elif is_nested(f):
        size = f"octet_length(to_json(struct({c} AS v))) * 1.0D"
    elif isinstance(t, T.StructType):
        size = "16.0D"
    else:
        size = "8.0D"
    return f"if({c} IS NULL, 0.25D, 0.25D + {size})"


def checked_rows(raw: DataFrame, schema: T.StructType, zone: str = C.DEFAULT_ZONE, max_row_bytes: int = MAX_ROW_BYTES, row: str = "row_json") -> DataFrame:
    """CONF1-9: raw with ``_row`` (typed struct in table order), ``_bytes`` and ``_error``.

    Up to :data:`WIDE` columns each has expressions of its own, in generated
    code; beyond, columns of one type share a program, see ``_by_type``.
    """
    if len(schema.fields) > WIDE:
        return with_errors(_by_type(parsed_rows(spread(raw, schema), row), schema, zone, row), raw.columns, schema, max_row_bytes)
    fields = list(enumerate(schema.fields))
    names = [f.name for f in schema.fields]
    declared = {f.name: f.metadata.get("declared", f.name) for f in schema.fields}
    required = [f.name for f in schema.fields if not f.nullable]
    rows = found_values(parsed_rows(spread(raw, schema), row), schema, row)

    def parts(i: int, f: T.StructField) -> C.Parts:
        if not is_nested(f):
            return (yield from C.coerce.parts(f, C.named(f"_t{i}"), C.named(f"_k{i}"), zone))
        pair = yield nested(F.col(f"_v{i}"), f.dataType, F.lit(dot_path(f.name)), f.nullable, zone, f.metadata)
        value, errors = pair["value"], pair["errors"]
        first = yield F.when(F.col(f"_k{i}").isNotNull() & (F.size(errors) > 0), F.concat_ws("; ", F.transform(errors, lambda e: F.concat(e["path"], F.lit(": "), e["what"]))))
        code = F.when(first.isNotNull(), F.coalesce(F.get(errors, F.lit(0))["code"], F.lit(C.BAD_TYPE)))
        return F.struct(value.alias("value"), code.alias("code"), first.alias("reason"))

    def bad_value(i: int, f: T.StructField) -> Column:
        c, name = f"_c{i}", declared[f.name]
        became_null = f"WHEN {c}.value IS NULL AND _k{i} IS NOT NULL THEN struct('{C.BAD_VALUE}' AS code, {sql_text(f'{name}: null in a required column')} AS message)"  # CONF6
        return F.expr(f"CASE WHEN {c}.code IS NOT NULL THEN struct({c}.code AS code, concat({sql_text(name + ': ')}, {c}.reason) AS message) {'' if f.nullable else became_null} END")

    # a few columns at a time, so that generated methods stay small
    group = GROUP if len(fields) <= MANY else len(fields)
    for first in range(0, len(fields), group):
        some = fields[first : first + group]
        rows = C.coerced(rows, {f"_c{i}": parts(i, f) for i, f in some})
        rows = once(rows, {f"_w{i}": F.col(f"_c{i}.value") for i, _ in some} | {f"_e{i}": bad_value(i, f) for i, f in some})
        rows = rows.drop(*[f"{c}{i}" for i, _ in some for c in ("_c", "_t", "_v")])
    values = {f.name: f"_w{i}" for i, f in fields}
    lacking = lambda wanted: F.expr("array_compact(array(" + ", ".join(f"CASE WHEN _k{i} {wanted} THEN {sql_text(declared[f.name])} END" for i, f in fields if not f.nullable) + "))") if required else F.array().cast(_NO_NAMES)
    rows = rows.withColumns({
        "_row": F.struct(*[F.col(c).alias(name) for name, c in values.items()]),
        "_missing": lacking("IS NULL"),
        "_nulls": lacking("= 'null'"),
        "_bad": F.array_compact(F.array(*[F.col(f"_e{i}") for i, _ in fields])),
        "_bytes": row_bytes(schema, values),
    })
    return with_errors(rows, raw.columns, schema, max_row_bytes)


def with_errors(rows: DataFrame, columns: list[str], schema: T.StructType, max_row_bytes: int) -> DataFrame:
    """CONF7: ``columns`` with ``_row``, ``_bytes`` and ``_error``, from what was found
    (``_keys``, ``_names``, ``_row``, ``_missing``, ``_nulls``, ``_bad``, ``_bytes``)."""
    no_names = F.lit(None).cast(_NO_NAMES)
    known = F.expr("array(" + ", ".join(sql_text(f.name) for f in schema.fields) + ")") if len(schema.fields) else F.array().cast(_NO_NAMES)
    strange = F.array_except("_names", known)
    rows = rows.withColumn("_extra", F.when(F.size(strange) > 0, F.filter("_keys", lambda k: ~F.array_contains(known, unquote_name(k)))))

    def error(code: Column | str, message: Column, extra=no_names, missing=no_names, nulls=no_names) -> Column:
        code = F.lit(code) if isinstance(code, str) else code
        return F.struct(code.alias("code"), message.alias("message"), extra.alias("extra_columns"), missing.alias("missing_not_null"), nulls.alias("null_not_null"))

    listed = lambda what, c: F.concat(F.lit(what + ": "), F.array_join(c, ", "))
    found = (
        F.when(F.col("_names").isNull(), error(C.BAD_VALUE, F.lit("the row is not an object of unique names")))
        .when(F.size("_extra") > 0, error(C.BAD_TYPE, listed("extra columns", F.col("_extra")), extra=F.col("_extra")))
        .when(F.size("_missing") > 0, error(C.BAD_TYPE, listed("missing required columns", F.col("_missing")), missing=F.col("_missing")))
        .when(F.size("_nulls") > 0, error(C.BAD_TYPE, listed("null in required columns", F.col("_nulls")), nulls=F.col("_nulls")))
        .when(F.size("_bad") > 0, error(F.col("_bad")[0]["code"], F.array_join(F.transform("_bad", lambda e: e["message"]), "; ")))
        .when(F.col("_bytes") > max_row_bytes, error("0031", F.concat(F.lit(f"row over {max_row_bytes} bytes: "), F.col("_bytes").cast("string"))))
        .otherwise(F.lit(None).cast(ERROR_TYPE))
    )
    kept = [*columns, "_row", "_bytes"]
    return once(rows.select(*kept, "_names", "_extra", "_missing", "_nulls", "_bad"), {"_error": found}).select(*kept, "_error")


def _alike(fields: list[T.StructField]) -> dict[tuple, list[int]]:
    """The places of the columns that one program coerces, by what it depends on; a nested column has its own."""
    out: dict[tuple, list[int]] = {}
    for i, f in enumerate(fields):
        told = tuple(sorted((k, str(v)) for k, v in f.metadata.items() if k not in ("declared", "ordinal")))
        out.setdefault((f.dataType.json(), told, i if is_nested(f) else -1), []).append(i)
    return out


def _by_type(rows: DataFrame, schema: T.StructType, zone: str, row: str) -> DataFrame:
    """What :func:`with_errors` needs of ``parsed_rows``, by one program a type.

    The cells of all columns of a type are one array; the program runs over
    it as a lambda.  So the plan grows with the number of types, and what is
    left to write for each column is a name and a place.
    """
    fields = schema.fields
    groups = list(_alike(fields).values())
    texts = lambda values: "array(" + ", ".join(values) + ")"
    names, declared = [sql_text(f.name) for f in fields], [sql_text(f.metadata.get("declared", f.name)) for f in fields]
    is_map = isinstance(rows.schema[row].dataType, T.MapType)

    rows = rows.withColumn("_back", F.reverse("_names"))
    rows = rows.withColumns({f"_at{g}": F.expr(f"transform({texts(names[i] for i in some)}, n -> size(_back) - int(array_position(_back, n)))") for g, some in enumerate(groups)})
    if is_map:
        kind, variant = "CASE WHEN p < size(_back) THEN CASE WHEN get(_values, p) IS NULL THEN 'null' ELSE 'string' END END", "coalesce(try_parse_json(get(_values, p)), CAST(get(_values, p) AS VARIANT))"
    else:
        variant = "try_element_at(_fields, get(_keys, p))"
        kind = f"CASE WHEN p < size(_back) THEN aggregate(CAST(array() AS array<int>), schema_of_variant({variant}), (s, x) -> s, s -> {_KIND.format(s='s')}) END"
    cells = {f"_cells{g}": F.expr(f"transform(_at{g}, p -> named_struct('t', get(_values, p), 'k', {kind}))") for g, _ in enumerate(groups)}
    variants = {f"_variant{g}": F.expr(f"transform(_at{g}, p -> {variant})[0]") for g, some in enumerate(groups) if is_nested(fields[some[0]])}
    rows = rows.withColumns(cells | variants)

    def results(g: int, f: T.StructField) -> Column:
        if not is_nested(f):
            return F.transform(f"_cells{g}", lambda c: C.coerce(f, c["t"], c["k"], zone))
        pair = nested(F.col(f"_variant{g}"), f.dataType, F.lit(dot_path(f.name)), f.nullable, zone, f.metadata)

        def told(p: Column) -> Column:
            errors, given = p["errors"], F.col(f"_cells{g}")[0]["k"].isNotNull() & (F.size(p["errors"]) > 0)
            reason = F.when(given, F.concat_ws("; ", F.transform(errors, lambda e: F.concat(e["path"], F.lit(": "), e["what"]))))
            code = F.when(given, F.coalesce(F.get(errors, F.lit(0))["code"], F.lit(C.BAD_TYPE)))
            return F.array(F.struct(p["value"].alias("value"), code.alias("code"), reason.alias("reason")))

        return C.let(pair, told)

    rows = once(rows, {f"_r{g}": results(g, fields[some[0]]) for g, some in enumerate(groups)})

    def listed(g: int, some: list[int], over: str, wanted: str, what: str) -> str:
        told = f"named_struct('i', get({texts(map(str, some))}, j), {what.format(name=f'get({texts(declared[i] for i in some)}, j)')})"
        return f"filter(transform({over}{g}, (c, j) -> CASE WHEN {wanted} THEN {told} END), e -> e IS NOT NULL)"

    errors, missing, nulls, sizes = [], [], [], []
    for g, some in enumerate(groups):
        errors.append(listed(g, some, "_r", "c.code IS NOT NULL", "'code', c.code, 'message', concat({name}, ': ', c.reason)"))
        sizes.append(f"aggregate(_r{g}, 0.0D, (a, c) -> a + {sized(fields[some[0]], 'c.value')})")
        if needed := [str(not fields[i].nullable).lower() for i in some if not fields[i].nullable]:
            needed = f"get({texts(str(not fields[i].nullable).lower() for i in some)}, j)"
            became = f"{needed} AND c.code IS NULL AND c.value IS NULL AND get(_cells{g}, j).k IS NOT NULL"  # CONF6
            errors.append(listed(g, some, "_r", became, f"'code', '{C.BAD_VALUE}', 'message', concat({{name}}, ': null in a required column')"))
            missing.append(listed(g, some, "_cells", f"{needed} AND c.k IS NULL", "'name', {name}"))
            nulls.append(listed(g, some, "_cells", f"{needed} AND c.k = 'null'", "'name', {name}"))
    place = {i: (g, k) for g, some in enumerate(groups) for k, i in enumerate(some)}
    in_order = lambda found, value: F.expr(f"transform(array_sort(concat({', '.join(found)})), e -> {value})") if found else F.array().cast(_NO_NAMES)
    return rows.withColumns({
        "_row": F.expr("named_struct(" + ", ".join(f"{names[i]}, get(_r{g}, {k}).value" for i, (g, k) in sorted(place.items())) + ")"),
        "_missing": in_order(missing, "e.name"),
        "_nulls": in_order(nulls, "e.name"),
        "_bad": in_order(errors, "named_struct('code', e.code, 'message', e.message)"),
        "_bytes": F.ceil(F.expr(" + ".join(sizes))),
    })


def conform(
    raw: DataFrame, schema: T.StructType, on_error: str | DataFrame = CONTINUE, zone: str = C.DEFAULT_ZONE, max_row_bytes: int = MAX_ROW_BYTES,
    row: str = "row_json", raise_on_abort: bool = False, batch_warning: int = BATCH_WARNING,
) -> Conformed:
    """(good, errors, report) of raw (table, channel, batch_id, row_index, row_json).

    ``on_error`` is one policy, or a frame (table, channel, on_error) of one
    per channel (POL4), joined to the batch counts and to the rows.
    """
    return by_policy(checked_rows(raw, schema, zone, max_row_bytes, row), schema, on_error, row, raise_on_abort, batch_warning)


def by_policy(rows: DataFrame, schema: T.StructType, on_error: str | DataFrame = CONTINUE, row: str = "row_json", raise_on_abort: bool = False, batch_warning: int = BATCH_WARNING) -> Conformed:
    """POL1-4: :func:`conform` from the checked rows on; all three frames read ``rows``, which a caller may store."""
    names = [f.name for f in schema.fields]
    keep = [*KEYS, "row_index"]
    checked = rows.select(*keep, F.col(row).alias("_content"), "_row", "_bytes", "_error")
    if isinstance(on_error, str):
        checked = checked.withColumn("_policy", F.lit(on_error))
    else:
        policies = on_error.select("table", "channel", F.lower("on_error").alias("_policy"))
        checked = checked.join(policies, ["table", "channel"], "left").withColumn("_policy", F.coalesce("_policy", F.lit(CONTINUE)))

    is_bad = F.col("_error").isNotNull()
    report = checked.groupBy(*KEYS, "_policy").agg(
        F.count("*").alias("row_count"), F.count_if(is_bad).alias("error_rows"), F.sum(F.when(~is_bad, F.col("_bytes")).otherwise(0)).alias("batch_bytes"),
    )
    status = F.when((F.col("error_rows") == 0) | (F.col("_policy") == CONTINUE), "loaded").when(F.col("_policy") == ABORT, "aborted").otherwise("skipped")
    report = report.withColumn("status", status).withColumns({
        "loaded_rows": F.when(F.col("status") == "loaded", F.col("row_count") - F.col("error_rows")).otherwise(0),
        "warnings": F.when(F.col("batch_bytes") > batch_warning, F.array(F.lit(f"batch over {batch_warning} bytes"))).otherwise(F.array().cast(_NO_NAMES)),
    })
    report = report.withColumnRenamed("_policy", "on_error")

    bad = checked.where(is_bad)
    good = checked.where(~is_bad)
    if on_error != CONTINUE if isinstance(on_error, str) else True:
        lost = bad.where(F.col("_policy") != CONTINUE).select(*KEYS).distinct()
        good = good.join(lost, [*KEYS], "left_anti")
    good = good.select(*keep, *[F.col("_row")[n].alias(n, metadata=schema[n].metadata) for n in names])

    first = bad.where(F.col("_policy") == ABORT).groupBy(*KEYS).agg(F.min_by(F.struct("row_index", "_content", "_error"), "row_index").alias("_first"))
    if raise_on_abort:
        found = first.orderBy(*KEYS).limit(1).collect()
        if found:
            e = found[0]["_first"]
            raise BatchAborted(f"{e['_error']['code']}: {e['_error']['message']} (channel {found[0]['channel']}, batch {found[0]['batch_id']}, row {e['row_index']})")
    shape = lambda df: df.select(*keep, F.col("_content").alias("row_content"), "_error.*")
    errors = shape(bad.where(F.col("_policy") != ABORT))
    if not isinstance(on_error, str) or on_error == ABORT:
        errors = errors.unionByName(shape(first.select(*KEYS, "_first.*")))
    return Conformed(good, errors, report)
