"""Table schemas: column metadata and nested JSON types to Spark types.

What a table needs beyond a Spark type travels in ``StructField.metadata``:
``logical`` kind, limits, scales, field ids and the declared spelling of names.
All of this is driver-side work on schemas, done once per table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MAX_TEXT = 16 * 1024 * 1024
MAX_BINARY = 8 * 1024 * 1024
MAX_SEMI = MAX_TEXT - 64

#: Logical types by ordinal of the metadata protocol are given by name here.
SEMI_STRUCTURED = ("VARIANT", "OBJECT", "ARRAY")
TEXTS = ("TEXT", "CHAR", "ANY")
TIMESTAMPS = ("TIMESTAMP_NTZ", "TIMESTAMP_LTZ", "TIMESTAMP_TZ")

WIDE_TIMESTAMP = T.StructType([T.StructField("epoch_s", T.LongType()), T.StructField("nanos", T.IntegerType()), T.StructField("offset_min", T.IntegerType())])


class UnsupportedSchema(ValueError):
    """A column that cannot be loaded; ``code`` 0005 or 0029."""

    def __init__(self, message: str, code: str = "0029"):
        super().__init__(f"{code}: {message}")
        self.code = code


def unquote(name: str) -> str:
    """Outer quotes off and doubled ones single; without them ``\\ `` is a space and letters are upper case."""
    if re.fullmatch(r'"(?:""|[^"])*"', name, re.S):
        return name[1:-1].replace('""', '"')
    return name.replace("\\ ", " ").upper()


def _field(name: str, kind: T.DataType, nullable: bool, **metadata) -> T.StructField:
    return T.StructField(unquote(name), kind, nullable, {"declared": name} | {k: v for k, v in metadata.items() if v is not None})


def column_field(column: dict) -> T.StructField:
    """One column of the metadata protocol: name, logicalType, physicalType,
    precision, scale, length, byteLength, nullable, collation, ordinal."""
    name, logical = column["name"], str(column.get("logicalType", "")).upper()
    physical, nullable = str(column.get("physicalType", "")).upper(), bool(column.get("nullable", True))
    precision, scale = column.get("precision"), column.get("scale")
    ordinal = column.get("ordinal")
    if column.get("collation"):
        raise UnsupportedSchema(f"column {name}: collation {column['collation']} is not supported")
    if column.get("sourceIcebergDataType"):
        kind = iceberg_type(column["sourceIcebergDataType"])
        return _field(name, kind, nullable, ordinal=ordinal, **_iceberg_limits(column["sourceIcebergDataType"]))
    if logical == "FIXED":
        return _field(name, T.DecimalType(precision or 38, scale or 0), nullable, logical=logical, physical=physical, ordinal=ordinal)
    if logical == "REAL":
        return _field(name, T.DoubleType(), nullable, logical=logical, ordinal=ordinal)
    if logical == "BOOLEAN":
        return _field(name, T.BooleanType(), nullable, logical=logical, ordinal=ordinal)
    if logical in TEXTS:
        return _field(name, T.StringType(), nullable, logical="TEXT", max_chars=column.get("length"), max_bytes=MAX_TEXT, ordinal=ordinal)
    if logical == "BINARY":
        return _field(name, T.BinaryType(), nullable, logical=logical, max_bytes=column.get("byteLength") or MAX_BINARY, ordinal=ordinal)
    if logical == "DATE":
        return _field(name, T.DateType(), nullable, logical=logical, ordinal=ordinal)
    if logical == "TIME":
        if physical not in ("SB4", "SB8") or not 0 <= (scale if scale is not None else 9) <= 9:
            raise UnsupportedSchema(f"column {name}: TIME({scale}) stored as {physical}")
        return _field(name, T.LongType(), nullable, logical=logical, time_scale=9 if scale is None else scale, ordinal=ordinal)
    if logical in TIMESTAMPS:
        if physical not in ("SB8", "SB16") or not 0 <= (scale if scale is not None else 9) <= 9:
            raise UnsupportedSchema(f"column {name}: {logical}({scale}) stored as {physical}")
        digits = 9 if scale is None else scale
        native = T.TimestampNTZType() if logical == "TIMESTAMP_NTZ" else T.TimestampType()
        return _field(name, WIDE_TIMESTAMP if digits > 6 or logical == "TIMESTAMP_TZ" else native, nullable, logical=logical, ts_scale=digits, ordinal=ordinal)
    if logical in SEMI_STRUCTURED:
        return _field(name, T.StringType(), nullable, logical=logical, semi_structured=logical, ordinal=ordinal)
    raise UnsupportedSchema(f"column {name}: type {logical or '(none)'} is not supported", "0005")


def table_schema(columns: list[dict]) -> T.StructType:
    """SCH1: schema of a table from its column metadata."""
    return T.StructType([column_field(c) for c in columns])


_PRIMITIVE = {
    "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(),
    "binary": T.BinaryType(), "date": T.DateType(), "time": T.LongType(), "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(), "uuid": T.StringType(),
}


def _iceberg_limits(text) -> dict:
    name = text if isinstance(text, str) else ""
    if m := re.fullmatch(r"fixed\s*[\[(]\s*(\d+)\s*[\])]", name.strip('" ')):
        return {"logical": "ICEBERG", "exact_bytes": int(m[1])}
    if name.strip('" ') == "time":
        return {"logical": "ICEBERG", "time_scale": 6}
    return {"logical": "ICEBERG"}


def iceberg_type(spec: str | dict) -> T.DataType:
    """SCH2: a nested type from its JSON form; field ids go to the metadata."""
    if isinstance(spec, str):
        text = spec.strip()
        if text.startswith("{"):
            return iceberg_type(json.loads(text))
        text = text.strip('"')
        if text in _PRIMITIVE:
            return _PRIMITIVE[text]
        if m := re.fullmatch(r"decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)", text):
            return T.DecimalType(int(m[1]), int(m[2]))
        if re.fullmatch(r"fixed\s*[\[(]\s*\d+\s*[\])]", text):
            return T.BinaryType()
        raise UnsupportedSchema(f"type {spec!r} is not supported", "0005")
    kind = spec.get("type")
    if kind == "struct":
        return T.StructType([T.StructField(f["name"], iceberg_type(f["type"]), not f.get("required", False), {"field_id": f["id"]} if "id" in f else {}) for f in spec["fields"]])
    if kind == "list":
        return T.ArrayType(iceberg_type(spec["element"]), not spec.get("element-required", False))
    if kind == "map":
        return T.MapType(iceberg_type(spec["key"]), iceberg_type(spec["value"]), not spec.get("value-required", False))
    raise UnsupportedSchema(f"type {kind!r} is not supported", "0005")


def dot_path(*names: str) -> str:
    """SCH4: names joined by dots, with ``\\`` and ``.`` inside names escaped."""
    return ".".join(n.replace("\\", "\\\\").replace(".", "\\.") for n in names)


@dataclass(frozen=True)
class Leaf:
    """SCH3, SCH5: a primitive column of a schema.

    ``names`` is the path with the levels of lists and maps in it;
    ``repeated`` whether any of these is a list or map.
    """

    names: tuple[str, ...]
    type: T.DataType
    ordinal: int
    field_id: int
    repeated: bool

    @property
    def path(self) -> str:
        return dot_path(*self.names)


def leaves(schema: T.StructType) -> list[Leaf]:
    """Leaves in pre-order."""
    return [leaf for i, f in enumerate(schema.fields) for leaf in _leaves(f, (f.name,), f.metadata.get("ordinal", i + 1), f.metadata.get("field_id", 0), False)]


def _leaves(field: T.StructField, names: tuple[str, ...], ordinal: int, field_id: int, repeated: bool) -> Iterator[Leaf]:
    kind = field.dataType
    if isinstance(kind, T.StructType) and not field.metadata.get("ts_scale"):
        for f in kind.fields:
            yield from _leaves(f, (*names, f.name), ordinal, f.metadata.get("field_id", 0), repeated)
    elif isinstance(kind, T.ArrayType):
        yield from _leaves(T.StructField("element", kind.elementType), (*names, "list", "element"), ordinal, field_id, True)
    elif isinstance(kind, T.MapType):
        yield from _leaves(T.StructField("key", kind.keyType), (*names, "key_value", "key"), ordinal, field_id, True)
        yield from _leaves(T.StructField("value", kind.valueType), (*names, "key_value", "value"), ordinal, field_id, True)
    else:
        yield Leaf(names, kind, ordinal, field_id, repeated)


def schema_of(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """SCH7: the schema as a table, one row per leaf."""
    rows = [(leaf.path, leaf.type.simpleString(), leaf.ordinal, leaf.field_id, leaf.repeated) for leaf in leaves(schema)]
    return spark.createDataFrame(rows, "column string, type string, ordinal int, field_id int, repeated boolean")


def missing_required(file_columns: list[str], schema: T.StructType) -> list[str]:
    """SCH8: columns that the schema now requires and a file does not have (such a file is rejected, code 40)."""
    have = set(file_columns)
    return [f.metadata.get("declared", f.name) for f in schema.fields if not f.nullable and f.name not in have]
