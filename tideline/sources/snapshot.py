"""Consistent snapshots as change logs: every row an insert at log position 0 of transaction 0."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.avro import encode_table
from ..functions.tagged_json import json_column
from .catalog import CatalogError, Table


def snapshot_log(df: DataFrame, table: Table) -> DataFrame:
    """Typed change log of one table. ``seq`` numbers the rows; it is their place in the scan, not an order.

    The numbers tell rows apart that are equal in all columns, and computing a task again gives the same ones.
    The new row is the struct of all columns; key columns are taken from it. A
    projection only: column pruning and filters reach the scan.
    """
    key = F.struct(*table.key) if table.key else F.lit(None)
    return df.select(
        F.lit(0).cast("long").alias("lsn"),
        F.monotonically_increasing_id().alias("seq"),
        F.lit(0).cast("long").alias("xid"),
        F.lit("insert").alias("kind"),
        F.lit(table.relid).cast("long").alias("relid"),
        F.lit(table.namespace).alias("namespace"),
        F.lit(table.name).alias("table_name"),
        key.alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("new"),
    )


def encoded_snapshot(df: DataFrame, table: Table, form: str = "json", decimals: str = "double") -> DataFrame:
    """``relid, namespace, table_name, key, value`` with encoded key and row.

    ``form`` is json (text) or avro (binary); a union of tables has one schema this way.
    """
    tag = [F.lit(table.relid).cast("long").alias("relid"), F.lit(table.namespace).alias("namespace"), F.lit(table.name).alias("table_name")]
    if form == "json":
        key = json_column(df.schema, table.key, decimals) if table.key else F.lit(None).cast("string")
        return df.select(*tag, key.alias("key"), json_column(df.schema, df.columns, decimals).alias("value"))
    if form != "avro":
        raise ValueError(f"output format must be avro or json, not {form!r}")
    if not table.key:
        return encode_table(df, table.name, out="value", namespace=table.namespace, decimals=decimals).select(
            *tag, F.lit(None).cast("binary").alias("key"), "value"
        )
    rows = encode_table(df, table.name, out="value", namespace=table.namespace, decimals=decimals, keep=table.key)
    return encode_table(rows, table.key_index, table.key, "key", table.namespace, decimals, keep=["value"]).select(
        *tag, "key", "value"
    )


def export(
    read: Callable[[str], DataFrame], tables: list[Table], form: str = "json", allow_unkeyed: bool = False
) -> DataFrame:
    """All tables in one frame of encoded rows. Unkeyed tables are an error unless allowed."""
    if not allow_unkeyed and (loose := [t.name for t in tables if not t.key]):
        raise CatalogError(f"tables without a key: {', '.join(loose)}; allow unkeyed tables or give them a key")
    if not tables:
        raise CatalogError("no tables to export")
    return reduce(DataFrame.unionByName, [encoded_snapshot(read(t.name), t, form) for t in tables])


def hand_over(snapshot: DataFrame, stream_log: DataFrame, start_lsn: int) -> DataFrame:
    """Snapshot rows, then the log after the snapshot's position: no gap, no row twice."""
    return snapshot.unionByName(stream_log.filter(F.col("lsn") > start_lsn), allowMissingColumns=True)
