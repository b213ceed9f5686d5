"""Table discovery over catalog frames, and the choice of each table's key.

The frames have the columns of the system catalogs: ``classes(oid, relnamespace, relname,
relkind, relreplident, relpersistence)``, ``namespaces(oid, nspname)`` and ``indexes(indexrelid,
indrelid, indisprimary, indisreplident, indisvalid, indisready)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CatalogError(ValueError):
    pass


def discover(classes: DataFrame, namespaces: DataFrame, indexes: DataFrame, pattern: str = "%") -> DataFrame:
    """``relid, namespace, table_name, identity, key_index_id, key_index`` of the tables to copy.

    Ordinary, permanent tables whose name is LIKE ``pattern``, outside system schemas
    (``pg_%``, where _ is a wildcard, and information_schema). The key index is the
    valid, ready one that the identity names: the primary key for default and full,
    the chosen index for index.
    """
    c, n = classes.alias("c"), namespaces.alias("n")
    i, ic = indexes.alias("i"), classes.alias("ic")
    is_key = (F.col("c.relreplident").isin("d", "f") & F.col("i.indisprimary")) | (
        (F.col("c.relreplident") == "i") & F.col("i.indisreplident")
    )
    on_index = (F.col("c.oid") == F.col("i.indrelid")) & F.col("i.indisvalid") & F.col("i.indisready") & is_key
    wanted = (
        (F.col("c.relkind") == "r")
        & (F.col("c.relpersistence") == "p")
        & F.col("c.relname").like(pattern)
        & ~F.col("n.nspname").like("pg_%")
        & (F.col("n.nspname") != "information_schema")
    )
    return (
        c.join(n, F.col("c.relnamespace") == F.col("n.oid"))
        .filter(wanted)
        .join(i, on_index, "left")
        .join(ic, F.col("i.indexrelid") == F.col("ic.oid"), "left")
        .select(
            F.col("c.oid").alias("relid"),
            F.col("n.nspname").alias("namespace"),
            F.col("c.relname").alias("table_name"),
            F.col("c.relreplident").alias("identity"),
            F.col("i.indexrelid").alias("key_index_id"),
            F.col("ic.relname").alias("key_index"),
        )
    )


def key_for_stream(classes: DataFrame, indexes: DataFrame) -> DataFrame:
    """``relid, key_index_id`` by the stream's rule: nothing -> none; index -> that index if
    valid; otherwise, or if it is missing, the valid and ready primary key."""
    usable = indexes.filter("indisvalid and indisready")
    primary = usable.filter("indisprimary").groupBy("indrelid").agg(F.min("indexrelid").alias("pk"))
    chosen = indexes.filter("indisvalid and indisreplident").groupBy("indrelid").agg(F.min("indexrelid").alias("ri"))
    joined = classes.join(primary, classes["oid"] == primary["indrelid"], "left").drop("indrelid")
    joined = joined.join(chosen, joined["oid"] == chosen["indrelid"], "left")
    key = F.when(F.col("relreplident") == "i", F.coalesce("ri", "pk")).when(F.col("relreplident") != "n", F.col("pk"))
    return joined.select(F.col("oid").alias("relid"), key.alias("key_index_id"))


def unkeyed(tables: DataFrame) -> DataFrame:
    """Tables without a key, each with why."""
    why = F.when(F.col("identity") == "n", F.lit("replica identity is NOTHING")).otherwise(F.lit("no primary key"))
    return tables.filter(F.col("key_index_id").isNull()).select("relid", "namespace", "table_name", why.alias("reason"))


def ambiguous(tables: DataFrame) -> DataFrame:
    """Tables with more than one key index."""
    return tables.groupBy("relid").agg(F.count("*").alias("key_indexes")).filter("key_indexes > 1")


def check(tables: DataFrame, allow_unkeyed: bool = False) -> None:
    """Raise for ambiguous keys and, unless allowed, for unkeyed tables; all are named at once.

    Catalog metadata only: a row per table.
    """
    twice = [r["relid"] for r in ambiguous(tables).orderBy("relid").collect()]
    if twice:
        raise CatalogError(f"more than one key index for tables {twice}")
    if not allow_unkeyed:
        found = unkeyed(tables).orderBy("namespace", "table_name").collect()
        if found:
            listed = "; ".join(f"{r['namespace']}.{r['table_name']} ({r['reason']})" for r in found)
            raise CatalogError(f"tables without a key: {listed}; allow unkeyed tables or give them a key")


@dataclass
class Table:
    """A table as the rest of the library sees it."""

    relid: int
    name: str
    key: list[str] = field(default_factory=list)
    namespace: str = "public"

    @property
    def key_index(self) -> str:
        return f"{self.name}_pkey"


def session_tables(spark: SparkSession, pattern: str = "%", database: str | None = None) -> list[str]:
    """Names of session-catalog tables LIKE the pattern, in order."""
    listed = spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")
    rows = listed.filter(F.col("tableName").like(pattern)).select("tableName").orderBy("tableName").collect()
    return [r[0] for r in rows]
