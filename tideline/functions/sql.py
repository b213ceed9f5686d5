"""SQL functions: schemas of tables as JSON text, and snapshot export as a view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..policy import ErrorPolicy
from ..sources.catalog import Table
from ..sources.snapshot import export
from .wire import frame_schema, key_schema, row_schema, schema_json


def register(spark: SparkSession, tables: list[Table], prefix: str = "tl_") -> None:
    """Register ``<prefix>row_schema(name)``, ``<prefix>key_schema(name)`` and ``<prefix>frame_schema()``.

    Schemas are read once, from session tables or views of the tables' names; an unknown
    name or the key of an unkeyed table fails the query.
    """
    known = "unknown table "
    rows, keys = [], []
    for t in tables:
        schema = spark.table(t.name).schema
        rows.append((t.name, _text(schema_json(row_schema(t.name, schema, t.namespace)))))
        key = schema_json(key_schema(t.key_index, schema, t.key, t.namespace)) if t.key else None
        keys.append((t.name, _text(key) if key else f"raise_error({_text(f'table {t.name} has no key')})"))

    def choice(cases: list[tuple[str, str]]) -> str:
        whens = " ".join(f"WHEN {_text(name)} THEN {value}" for name, value in cases)
        return f"CASE table_name {whens} ELSE raise_error(concat({_text(known)}, table_name)) END" if cases else f"raise_error({_text(known)})"

    for name, cases in (("row_schema", rows), ("key_schema", keys)):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(table_name STRING) RETURNS STRING RETURN {choice(cases)}")
    whole = _text(schema_json(frame_schema()))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}frame_schema() RETURNS STRING RETURN {whole}")


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def export_view(
    spark: SparkSession, tables: list[Table], view: str = "tl_export", form: str = "json", allow_unkeyed: bool = False
) -> DataFrame:
    """A temporary view of all rows of the tables as encoded messages; lazily planned, so filters reach the scans."""
    out = export(spark.table, tables, form, allow_unkeyed)
    out.createOrReplaceTempView(view)
    return out


def export_function(spark: SparkSession, tables: list[Table], name: str = "tl_export_like", form: str = "json", policy: ErrorPolicy = ErrorPolicy.EXIT) -> None:
    """Register the table function ``name(pattern, allow_unkeyed)``: rows of all tables whose name is LIKE the pattern.

    An unkeyed table among them fails the query unless allowed; under the log policy it is left out.
    """
    view = f"{name}_rows"
    export(spark.table, tables, form, allow_unkeyed=True).createOrReplaceTempView(view)
    loose = [t.name for t in tables if not t.key]
    keyed = f"table_name NOT IN ({', '.join(map(_text, loose))})" if loose else "true"
    otherwise = "false" if policy is ErrorPolicy.LOG else "raise_error(concat('table without a key: ', table_name)) IS NULL"
    kind = "STRING" if form == "json" else "BINARY"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(pattern STRING, allow_unkeyed BOOLEAN) "
        f"RETURNS TABLE (relid BIGINT, namespace STRING, table_name STRING, key {kind}, value {kind}) "
        f"RETURN SELECT relid, namespace, table_name, key, value FROM {view} "
        f"WHERE table_name LIKE pattern AND CASE WHEN allow_unkeyed OR {keyed} THEN true ELSE {otherwise} END"
    )
