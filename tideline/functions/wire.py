"""Wire types: source type names, Spark types, and the record schemas derived from them.

Every field is a union with null first. Named types (dates, times, intervals) are
defined where a record first uses them and referred to by name afterwards.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import types as T

from .naming import sanitise

ROOT = "tideline.dbschema"
DATATYPES = "tideline.datatypes"
FRAMES = "tideline.frames"
DUMMY = "dummy"

# Wire kind of every source type; all types not listed are sent as text.
SOURCE_TYPES: dict[str, str] = {
    "boolean": "boolean",
    "real": "float",
    "double precision": "double",
    "smallint": "int",
    "integer": "int",
    "bigint": "long",
    "money": "long",
    "oid": "long",
    "regproc": "long",
    "xid": "long",
    "cid": "long",
    "numeric": "double",
    "date": "Date",
    "time": "long",
    "timetz": "TimeTZ",
    "timestamp": "DateTime",
    "timestamptz": "DateTimeTZ",
    "interval": "Interval",
    "bytea": "bytes",
}
ALIASES = {
    "bool": "boolean", "float4": "real", "float8": "double precision", "int2": "smallint", "int4": "integer",
    "int8": "bigint", "decimal": "numeric", "serial": "integer", "bigserial": "bigint",
    "time without time zone": "time", "time with time zone": "timetz",
    "timestamp without time zone": "timestamp", "timestamp with time zone": "timestamptz",
}
WIRE_TO_SPARK: dict[str, T.DataType] = {
    "boolean": T.BooleanType(), "float": T.FloatType(), "double": T.DoubleType(), "int": T.IntegerType(),
    "long": T.LongType(), "bytes": T.BinaryType(), "string": T.StringType(),
}
_DAY = ("year", "month", "day")
_CLOCK = ("hour", "minute", "second", "micro")
# Fields of the named types in order; all are int but micro of TimeTZ.
NAMED: dict[str, tuple[str, ...]] = {
    "Date": _DAY,
    "TimeTZ": ("micro", "zoneOffset"),
    "DateTime": _DAY + _CLOCK,
    "DateTimeTZ": _DAY + _CLOCK + ("zoneOffset",),
    "Interval": _DAY + _CLOCK,
}
SPECIAL = ("POS_INFINITY", "NEG_INFINITY")
WITH_SPECIAL = ("Date", "DateTime", "DateTimeTZ")


def wire_kind_of_source(type_name: str) -> str:
    """Wire kind of a source type by name; modifiers in brackets are ignored, arrays are text."""
    name = type_name.strip().lower()
    if name.endswith("[]"):
        return "string"
    name = " ".join(name.split("(")[0].split() + (name.split(")", 1)[1].split() if ")" in name else []))
    return SOURCE_TYPES.get(ALIASES.get(name, name), "string")


def wire_kind(dtype: T.DataType, decimals: str = "double") -> str:
    """Wire kind of a Spark type. ``decimals="exact"`` sends decimals as text instead of doubles."""
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.FloatType):
        return "float"
    if isinstance(dtype, T.DoubleType):
        return "double"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return "int"
    if isinstance(dtype, T.LongType):
        return "long"
    if isinstance(dtype, T.DecimalType):
        return "double" if decimals == "double" else "string"
    if isinstance(dtype, T.DateType):
        return "Date"
    if isinstance(dtype, T.TimestampNTZType):
        return "DateTime"
    if isinstance(dtype, T.TimestampType):
        return "DateTimeTZ"
    if isinstance(dtype, T.BinaryType):
        return "bytes"
    return "string"


def named_definition(kind: str) -> dict[str, Any]:
    fields = [{"name": f, "type": "long" if (kind, f) == ("TimeTZ", "micro") else "int"} for f in NAMED[kind]]
    return {"type": "record", "name": kind, "namespace": DATATYPES, "fields": fields}


def special_definition() -> dict[str, Any]:
    return {"type": "enum", "name": "SpecialTime", "namespace": DATATYPES, "symbols": list(SPECIAL)}


def union(kind: str, defined: set[str]) -> list[Any]:
    """``[null, kind]`` with named types defined at their first use."""

    def named(name: str, definition: dict[str, Any]) -> Any:
        if name in defined:
            return f"{DATATYPES}.{name}"
        defined.add(name)
        return definition

    if kind not in NAMED:
        return ["null", kind]
    branches: list[Any] = ["null", named(kind, named_definition(kind))]
    if kind in WITH_SPECIAL:
        branches.append(named("SpecialTime", special_definition()))
    return branches


def row_schema(table: str, schema: T.StructType, namespace: str = "public", decimals: str = "double") -> dict[str, Any]:
    """Record schema of a table's rows. A table without columns has one boolean field ``dummy``."""
    defined: set[str] = set()
    fields = [
        {"name": sanitise(f.name), "type": union(wire_kind(f.dataType, decimals), defined), "default": None}
        for f in schema.fields
    ]
    if not fields:
        fields = [{"name": DUMMY, "type": ["null", "boolean"], "default": None}]
    return {
        "type": "record",
        "name": sanitise(table),
        "namespace": f"{ROOT}.{sanitise(namespace, namespace=True)}",
        "fields": fields,
    }


class UnkeyedTable(ValueError):
    pass


def key_schema(
    index: str, schema: T.StructType, key_columns: list[str], namespace: str = "public", decimals: str = "double"
) -> dict[str, Any]:
    """Record schema of a table's key, named after the key's index; columns in index order."""
    if not key_columns:
        raise UnkeyedTable(f"no key for {index}")
    return row_schema(index, T.StructType([schema[c] for c in key_columns]), namespace, decimals)


def schema_json(schema: dict[str, Any]) -> str:
    return json.dumps(schema, separators=(",", ":"), ensure_ascii=False)


# The messages of a frame by tag, with their fields.
FRAME_MESSAGES: tuple[tuple[str, tuple[tuple[str, Any], ...]], ...] = (
    ("BeginTxn", (("xid", "long"),)),
    ("CommitTxn", (("xid", "long"), ("lsn", "long"))),
    ("TableSchema", (("relid", "long"), ("keySchema", ["null", "string"]), ("rowSchema", "string"))),
    ("Insert", (("relid", "long"), ("key", ["null", "bytes"]), ("newRow", "bytes"))),
    ("Update", (("relid", "long"), ("key", ["null", "bytes"]), ("oldRow", ["null", "bytes"]), ("newRow", "bytes"))),
    ("Delete", (("relid", "long"), ("key", ["null", "bytes"]), ("oldRow", ["null", "bytes"]))),
)


def frame_schema() -> dict[str, Any]:
    messages = [
        {"type": "record", "name": name, "namespace": FRAMES, "fields": [{"name": f, "type": t} for f, t in fields]}
        for name, fields in FRAME_MESSAGES
    ]
    field = {"name": "msg", "type": {"type": "array", "items": messages}}
    return {"type": "record", "name": "Frame", "namespace": FRAMES, "fields": [field]}
