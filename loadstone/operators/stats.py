"""Column statistics: one row per (group, leaf column), mergeable.

Plain columns of a group are measured in one aggregate, then turned to long
form; each list or map below is exploded once for its leaves.  Minimum and
maximum come in three kinds: ``int`` (booleans, dates, times, timestamps and
decimals as scaled integers), ``real`` and ``bytes`` (unsigned order of UTF-8).
Semi-structured columns have null counts only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.functions.coerce import scaled_timestamp, zoned_timestamp
from loadstone.plans.schema import Leaf, dot_path, leaves

WIDE = "decimal(38,0)"


def kind_of(kind: T.DataType, metadata: dict | None = None) -> str:
    """``int``, ``real``, ``bytes`` or ``none``."""
    if (metadata or {}).get("semi_structured"):
        return "none"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "real"
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return "bytes"
    return "int"


def as_integer(c: Column, kind: T.DataType, metadata: dict | None = None) -> Column:
    """AGG3: the scaled integer that a value is ordered by."""
    m = metadata or {}
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast(WIDE)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast(WIDE)
    if isinstance(kind, T.StructType):
        scale = m.get("ts_scale", 9)
        if m.get("logical") == "TIMESTAMP_TZ":
            return zoned_timestamp(c["epoch_s"], c["nanos"], c["offset_min"], scale)
        return scaled_timestamp(c["epoch_s"], c["nanos"], scale)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        scale = m.get("ts_scale", 6)
        wall = c if isinstance(kind, T.TimestampType) else F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")
        micros = F.unix_micros(wall)
        return F.floor(micros / 10 ** (6 - scale)).cast(WIDE) if scale < 6 else micros.cast(WIDE) * F.lit(10 ** (scale - 6)).cast("decimal(4,0)")
    if isinstance(kind, T.DecimalType):
        return (c.cast(T.DecimalType(38, kind.scale)) * F.lit(10**kind.scale).cast(T.DecimalType(kind.scale + 1, 0))).cast(WIDE)
    return c.cast(WIDE)


def is_negative_zero(c: Column) -> Column:
    return (c == 0) & (c.cast("string") == "-0.0")


def least_real(c: Column) -> Column:
    """AGG4: the minimum by which -0.0 is under 0.0 and NaN is over all (Spark takes the zeros for equal)."""
    sign = F.when(F.max(is_negative_zero(c)), F.lit(-1.0)).otherwise(F.lit(1.0))
    # times the zero itself: the optimizer takes the literals 0.0 and -0.0 for one
    return F.when(F.min(c) == 0, sign * F.abs(F.min(c))).otherwise(F.min(c))


def greatest_real(c: Column) -> Column:
    """AGG4: the maximum of the same order."""
    sign = F.when(F.max((c == 0) & ~is_negative_zero(c)), F.lit(1.0)).otherwise(F.lit(-1.0))
    return F.when(F.max(c) == 0, sign * F.abs(F.max(c))).otherwise(F.max(c))


def _measures(c: Column, kind: T.DataType, metadata: dict, distinct: str | None, nested: bool) -> Column:
    """One struct of all measures of a column: a single pass of partial aggregates."""
    what = kind_of(kind, metadata)
    null = lambda t: F.lit(None).cast(t)
    number, real, raw = as_integer(c, kind, metadata) if what == "int" else null(WIDE), null("double"), null("binary")
    if what == "real":
        real = c.cast("double")
    if what == "bytes":
        raw = c if isinstance(kind, T.BinaryType) else F.encode(c, "utf-8")
    count, sketch = F.lit(-1).cast("bigint"), null("binary")
    if what != "none" and distinct == "approx":
        count = F.approx_count_distinct(c)
    elif what != "none" and distinct == "sketch":
        sketch = F.hll_sketch_agg(c if isinstance(kind, (T.StringType, T.BinaryType, T.IntegerType, T.LongType)) else c.cast("string"))
        count = F.hll_sketch_estimate(sketch)
    return F.struct(
        F.count("*").alias("row_count"), F.count_if(c.isNull()).alias("null_count"),
        (F.min(number) if what == "int" else number).alias("min_int"), (F.max(number) if what == "int" else number).alias("max_int"),
        (least_real(real) if what == "real" else real).alias("min_real"), (greatest_real(real) if what == "real" else real).alias("max_real"),
        (F.min(raw) if what == "bytes" else raw).alias("min_bytes"), (F.max(raw) if what == "bytes" else raw).alias("max_bytes"),
        (F.max(F.octet_length(c)) if what == "bytes" else F.lit(0)).cast("bigint").alias("max_length"), count.cast("bigint").alias("distinct_count"), sketch.alias("sketch"),
        (F.count("*") if nested else F.lit(-1).cast("bigint")).alias("value_count"),
    )


def _plain(df: DataFrame, by: list[str], columns: list[tuple[str, Column, T.DataType, dict]], distinct: str | None, nested: bool = False) -> DataFrame:
    long = _measured(df, by, columns, distinct, nested)
    counted = [(name, c) for name, c, t, m in columns if kind_of(t, m) != "none"]
    if distinct != "exact" or not counted:
        return long
    counts = _distinct_counts(df, by, counted).select(*[F.col(f"`{b}`").alias(f"_b{i}") for i, b in enumerate(by)], F.col("column").alias("_column"), "_distinct")
    same = reduce(lambda a, b: a & b, [F.col(f"`{b}`").eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)], F.col("column") == F.col("_column"))
    known = F.col("column").isin(*[name for name, _ in counted])
    found = F.when(known, F.coalesce("_distinct", F.lit(0))).otherwise(F.col("distinct_count")).cast("bigint")
    return long.join(counts, same, "left").withColumn("distinct_count", found).select(*[F.col(f"`{c}`") for c in long.columns])


def _distinct_counts(df: DataFrame, by: list[str], columns: list[tuple[str, Column]]) -> DataFrame:
    """AGG7: (by, column, _distinct) of the values of each column, without nulls.

    The values are brought together by hash, apart from the other measures: as one
    of several aggregates each row would be sorted once for each column, since
    bounds of bytes have no place in a hash table.
    """
    held = F.explode(F.array(*[F.struct(F.lit(name).alias("column"), *[(c if j == i else F.lit(None)).alias(f"v{j}") for j, (_, c) in enumerate(columns)]) for i, (name, _) in enumerate(columns)]))
    values = [f"_v{j}" for j in range(len(columns))]
    each = df.select(*[F.col(f"`{b}`") for b in by], held.alias("_e")).select(*[F.col(f"`{b}`") for b in by], F.col("_e.column").alias("column"), *[F.col(f"_e.v{j}").alias(v) for j, v in enumerate(values)])
    keys = [*[F.col(f"`{b}`") for b in by], F.col("column")]
    return each.where(reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values])).distinct().groupBy(*keys).agg(F.count("*").alias("_distinct"))


def _measured(df: DataFrame, by: list[str], columns: list[tuple[str, Column, T.DataType, dict]], distinct: str | None, nested: bool) -> DataFrame:
    wide = df.groupBy(*by).agg(*[_measures(c, t, m, distinct, nested).alias(f"_{i}") for i, (_, c, t, m) in enumerate(columns)])
    entries = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(kind_of(t, m)).alias("kind"), F.col(f"_{i}").alias("s")) for i, (name, _, t, m) in enumerate(columns)])
    return wide.select(*by, F.explode(entries).alias("e")).select(*by, "e.column", "e.kind", "e.s.*")


def _leaf_groups(schema: T.StructType) -> tuple[list[tuple[str, tuple[str, ...], T.DataType, dict]], dict[tuple[str, ...], list[Leaf]]]:
    plain, repeated = [], {}
    for leaf in leaves(schema):
        if not leaf.repeated:
            field = schema
            metadata: dict = {}
            for n in leaf.names:
                metadata = field[n].metadata
                field = field[n].dataType
            plain.append((leaf.path, leaf.names, leaf.type, metadata))
        else:
            at = next(i for i, n in enumerate(leaf.names) if n in ("list", "key_value"))
            repeated.setdefault(leaf.names[:at], []).append(leaf)
    return plain, repeated


def column_stats(df: DataFrame, by: list[str] | None = None, distinct: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """AGG1-9: statistics of the columns (all but ``by``) of each group.

    ``distinct`` is None (count -1), ``exact``, ``approx`` or ``sketch``: the
    last keeps HLL sketches, whose counts can be merged.
    """
    by = by or []
    schema = T.StructType([f for f in df.schema.fields if f.name not in by and (columns is None or f.name in columns)])
    plain, repeated = _leaf_groups(schema)
    parts = []
    if plain:
        get = lambda names: reduce(lambda c, n: c[n], names[1:], F.col(f"`{names[0]}`"))
        parts.append(_plain(df, by, [(path, get(names), t, m) for path, names, t, m in plain], distinct))
    for head in repeated:
        parts += _exploded(df.select(*by, reduce(lambda c, n: c[n], head[1:], F.col(f"`{head[0]}`")).alias("_v")), by, head, _type_at(schema, head), distinct)
    return reduce(DataFrame.unionByName, parts)


def _type_at(schema: T.StructType, names: tuple[str, ...]) -> T.DataType:
    kind: T.DataType = schema
    for n in names:
        kind = kind[n].dataType  # type: ignore[index]
    return kind


def _exploded(df: DataFrame, by: list[str], names: tuple[str, ...], kind: T.DataType, distinct: str | None) -> list[DataFrame]:
    """AGG9: an empty or null list or map counts as one null in each leaf below."""
    if isinstance(kind, T.ArrayType):
        return _exploded(df.select(*by, F.explode_outer("_v").alias("_v")), by, (*names, "list", "element"), kind.elementType, distinct)
    if isinstance(kind, T.MapType):
        pairs = df.select(*by, F.explode_outer("_v").alias("_k", "_w"))
        return _exploded(pairs.select(*by, F.col("_k").alias("_v")), by, (*names, "key_value", "key"), kind.keyType, distinct) + _exploded(pairs.select(*by, F.col("_w").alias("_v")), by, (*names, "key_value", "value"), kind.valueType, distinct)
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields for x in _exploded(df.select(*by, F.col("_v")[f.name].alias("_v")), by, (*names, f.name), f.dataType, distinct)]
    return [_plain(df, by, [(dot_path(*names), F.col("_v"), kind, {})], distinct, nested=True)]


def merge_stats(stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG10, SET4: partial statistics to larger groups.  Distinct counts do not add
    up: they come from the union of the sketches, and are -1 without sketches."""
    by = by or []
    total = lambda c: F.when(F.min(c) < 0, F.lit(-1)).otherwise(F.sum(c)).cast("bigint").alias(c)
    return stats.groupBy(*by, "column", "kind").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("min_int").alias("min_int"), F.max("max_int").alias("max_int"),
        least_real(F.col("min_real")).alias("min_real"), greatest_real(F.col("max_real")).alias("max_real"), F.min("min_bytes").alias("min_bytes"), F.max("max_bytes").alias("max_bytes"),
        F.max("max_length").alias("max_length"), F.when(F.count("sketch") > 0, F.hll_sketch_estimate(F.hll_union_agg("sketch"))).otherwise(-1).cast("bigint").alias("distinct_count"),
        F.when(F.count("sketch") > 0, F.hll_union_agg("sketch")).alias("sketch"), total("value_count"),
    )


def unequal_columns(stats: DataFrame, part: list[str], whole: list[str]) -> DataFrame:
    """AGG11, SET2: wholes whose parts do not all have the same columns (must be empty)."""
    per = stats.groupBy(*whole, *part).agg(F.array_sort(F.collect_set("column")).alias("_columns"))
    return per.groupBy(*whole).agg(F.count_distinct("_columns").alias("column_sets")).where("column_sets > 1")


def truncated_low(raw: Column, width: int = 32) -> Column:
    """AGG13: the first ``width`` bytes in hex, rounded down."""
    return F.lower(F.hex(F.substring(raw, 1, width)))


def truncated_high(raw: Column, width: int = 32) -> Column:
    """AGG13: rounded up with carry over FF bytes; ``Z`` if all are FF."""
    head = F.regexp_replace(F.hex(F.substring(raw, 1, width)), "(FF)+$", "")
    length = F.length(head)
    last = F.lpad(F.conv((F.conv(F.substr(head, length - 1, F.lit(2)), 16, 10).cast("int") + 1).cast("string"), 10, 16), 2, "0")
    up = F.rpad(F.lower(F.concat(F.substr(head, F.lit(1), length - 2), last)), 2 * width, "0")
    return F.when(F.octet_length(raw) <= width, F.lower(F.hex(raw))).when(length == 0, F.lit("Z")).otherwise(up)


def file_properties(stats: DataFrame, iceberg: bool = False) -> DataFrame:
    """AGG13, AGG14: the form of statistics that files are registered with:
    truncated hex bounds, and defaults for columns without values."""
    empty = lambda c, kind, value: F.when(F.lit(not iceberg) | (F.col("kind") == kind), F.coalesce(c, F.lit(value))).otherwise(c)
    text = lambda c: empty(c, "bytes", "") if iceberg else c
    return stats.withColumns({
        "min_int": empty(F.col("min_int"), "int", 0).cast(WIDE), "max_int": empty(F.col("max_int"), "int", 0).cast(WIDE),
        "min_real": empty(F.col("min_real"), "real", 0.0), "max_real": empty(F.col("max_real"), "real", 0.0),
        "min_string": text(truncated_low(F.col("min_bytes"))), "max_string": text(truncated_high(F.col("max_bytes"))),
    }).drop("min_bytes", "max_bytes", "sketch")


def violations(stats: DataFrame, distinct: bool = False) -> DataFrame:
    """AGG15: statistics that cannot be right (must be empty)."""
    repeated = F.col("column").rlike(r"\.(list\.element|key_value\.(key|value))")
    return stats.where((~repeated & (F.col("null_count") > F.col("row_count"))) | (F.lit(not distinct) & (F.col("distinct_count") != -1)))
