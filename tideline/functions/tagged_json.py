"""JSON messages in which every non-null value names its union branch: ``{"id": {"int": 1}}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .naming import sanitise
from .temporal import date_parts, timestamp_parts
from .wire import DATATYPES, wire_kind


def _value(col: Column, kind: str) -> Column:
    if kind == "bytes":
        return F.decode(col, "ISO-8859-1")  # one code point per byte
    if kind == "Date":
        return date_parts(col)
    if kind == "DateTime":
        return timestamp_parts(col)
    if kind == "DateTimeTZ":
        return timestamp_parts(col, F.lit(0))
    spark = {"int": "int", "long": "long", "float": "float", "double": "double", "boolean": "boolean", "string": "string"}
    return col.cast(spark[kind])


def branch_label(kind: str) -> str:
    """Named types are labelled with their full name."""
    return kind if kind in ("boolean", "float", "double", "int", "long", "bytes", "string") else f"{DATATYPES}.{kind}"


def json_column(df_schema: T.StructType, columns: list[str], decimals: str = "double") -> Column:
    """The record of ``columns`` as JSON text; nulls are written. No columns: the dummy field, null."""
    if not columns:
        return F.lit('{"dummy":null}')
    fields = []
    for name in columns:
        kind = wire_kind(df_schema[name].dataType, decimals)
        col = F.col(f"`{name}`")
        tagged = F.when(col.isNotNull(), F.struct(_value(col, kind).alias(branch_label(kind))))
        fields.append(tagged.alias(sanitise(name)))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
