"""Deterministic change logs made from the driver's tables, and literal fixtures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.avro import encode_table
from ..functions.wire import key_schema, row_schema, schema_json
from ..sources.catalog import Table

#: Key columns of every table; lineitem has none.
TABLES = (
    Table(1, "region", ["r_regionkey"]),
    Table(2, "nation", ["n_nationkey"]),
    Table(3, "customer", ["c_custkey"]),
    Table(4, "supplier", ["s_suppkey"]),
    Table(5, "part", ["p_partkey"]),
    Table(6, "orders", ["o_orderkey"]),
    Table(7, "lineitem", []),
    Table(8, "events", ["event_id"]),
    Table(9, "documents", ["doc_id"]),
    Table(10, "embeddings", ["vec_id"]),
    Table(11, "pages", ["page_id"]),
    Table(12, "benchmark", ["item_id"]),
    Table(13, "labels", ["doc_id"]),
    Table(14, "conversations", ["conv_id", "turn"]),
)
BY_NAME = {t.name: t for t in TABLES}
EVENTS_RELID = BY_NAME["events"].relid


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a log keyed by user: ten events a transaction; signups insert, errors delete."""
    e = table(spark, sf_dir, "events")
    return log_of_events(e)


def log_of_events(e: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update")
    return e.select(
        (F.col("event_id") + 1).alias("lsn"),
        F.lit(0).alias("seq"),
        (F.expr("event_id div 10") + 1).alias("xid"),
        kind.alias("kind"),
        F.lit(EVENTS_RELID).cast("long").alias("relid"),
        "event_id", "user_id", "event_type", "value", "props",
    )


def mutable_key_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as rows of a table whose identity is the user and whose key is the event type.

    Each event is the user's next row version; the key changes whenever the type does.
    """
    order = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, sf_dir, "events")
    old = F.lag(F.struct("event_type", "event_id")).over(order)
    return e.select(
        (F.col("event_id") + 1).alias("lsn"),
        F.lit(0).alias("seq"),
        (F.expr("event_id div 10") + 1).alias("xid"),
        F.when(old.isNull(), "insert").otherwise("update").alias("kind"),
        F.lit(EVENTS_RELID).cast("long").alias("relid"),
        F.struct("user_id", "event_type").alias("key"),
        F.when(old.isNotNull(), F.struct(F.col("user_id"), old["event_type"].alias("event_type"))).alias("old_key"),
        F.struct("user_id", "event_type", "event_id").alias("new"),
    )


def acknowledged() -> Column:
    return ~((F.col("event_type") == "click") & (F.col("event_id") % 97 == 0))


# Literal catalog: (oid, namespace, name, kind, identity, persistence), namespaces, indexes.
CLASSES = (
    (100, 1, "users", "r", "d", "p"), (101, 1, "accounts", "r", "f", "p"), (102, 1, "orders", "r", "i", "p"),
    (103, 1, "logs", "r", "n", "p"), (104, 1, "notes", "r", "d", "p"), (105, 1, "a_view", "v", "d", "p"),
    (106, 1, "fast", "r", "d", "u"), (107, 2, "pg_class", "r", "d", "p"), (108, 3, "hidden", "r", "d", "p"),
    (109, 4, "facts", "r", "d", "p"), (110, 1, "half_index", "r", "i", "p"), (111, 5, "sales", "r", "d", "p"),
    (112, 1, "broken", "r", "d", "p"),
    (200, 1, "users_pkey", "i", "n", "p"), (201, 1, "accounts_pkey", "i", "n", "p"), (202, 1, "orders_alt", "i", "n", "p"),
    (203, 1, "orders_pkey", "i", "n", "p"), (204, 1, "logs_pkey", "i", "n", "p"), (205, 5, "sales_pkey", "i", "n", "p"),
    (206, 1, "half_pkey", "i", "n", "p"), (207, 1, "broken_pkey", "i", "n", "p"),
)
NAMESPACES = ((1, "public"), (2, "pg_catalog"), (3, "pgx"), (4, "information_schema"), (5, "shop"))
INDEXES = (
    (200, 100, True, False, True, True), (201, 101, True, False, True, True), (202, 102, False, True, True, True),
    (203, 102, True, False, True, True), (204, 103, True, False, True, True), (205, 111, True, False, True, True),
    (206, 110, True, False, True, True), (207, 112, True, False, False, True),
)


def catalog(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = spark.createDataFrame(CLASSES, "oid long, relnamespace long, relname string, relkind string, relreplident string, relpersistence string")
    n = spark.createDataFrame(NAMESPACES, "oid long, nspname string")
    i = spark.createDataFrame(INDEXES, "indexrelid long, indrelid long, indisprimary boolean, indisreplident boolean, indisvalid boolean, indisready boolean")
    return c, n, i


#: Schema events of the events table: new, unchanged, changed, changed back.
SCHEMA_EVENTS = ((EVENTS_RELID, 1, -1, "v1"), (EVENTS_RELID, 301, -1, "v1"), (EVENTS_RELID, 501, -1, "v2"), (EVENTS_RELID, 701, -1, "v1"), (99, 5, -1, "x1"))


def schema_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCHEMA_EVENTS, "relid long, lsn long, seq int, schema_version string")


NAMES = ("users", "crêpes", "9lives", "a.b", "person/name", "flobble-biscuits?whatisthetime/hahahaha", "z" * 63, "_ok", "Straße 1", "日本")
#: Positions as text, and as signed 64-bit numbers: fixed values.
LSNS = (
    ("0/0", 0), ("42/BEEFCAFE", 286671227646), ("1/FF", 4294967551), ("7FFFFFFF/FFFFFFFF", 9223372036854775807), ("FFFFFFFF/FFFFFFFF", -1),
)


def encoded_events(spark: SparkSession, sf_dir: str, change_at: int) -> DataFrame:
    """events as an encoded event log: every tenth is a delete; from ``change_at`` on the table has another name and a column more."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    e = e.select("*", (F.col("event_id") + 1).alias("lsn"), F.lit(0).alias("seq"), (F.expr("event_id div 10") + 1).alias("xid"))
    kind = F.when(F.col("event_id") % 10 == 9, "delete").otherwise("insert")
    e = e.select("*", kind.alias("kind"), F.lit(EVENTS_RELID).cast("long").alias("relid"))
    head = ["lsn", "seq", "xid", "kind", "relid"]
    out = None
    for name, columns, rows in (
        ("events", ["event_id", "user_id"], e.filter(F.col("event_id") < change_at)),
        ("happenings", ["event_id", "user_id", "event_type"], e.filter(F.col("event_id") >= change_at)),
    ):
        schema = T.StructType([e.schema[c] for c in columns])
        key = schema_json(key_schema(f"{name}_pkey", schema, ["event_id"]))
        value = schema_json(row_schema(name, schema))
        with_row = encode_table(rows, name, columns, "new_row", keep=[*head, "event_id"])
        with_key = encode_table(with_row, f"{name}_pkey", ["event_id"], "key", keep=[*head, "new_row"])
        with_key = with_key.withColumn("new_row", F.when(F.col("kind") != "delete", F.col("new_row")))
        first = 0 if name == "events" else change_at + 1
        announced = spark.createDataFrame(
            [(first, -1, (change_at // 10 + 1) if first else 1, "schema", EVENTS_RELID, key, value)],
            "lsn long, seq int, xid long, kind string, relid long, key_schema string, row_schema string",
        )
        part = with_key.unionByName(announced, allowMissingColumns=True)
        out = part if out is None else out.unionByName(part)
    return out
