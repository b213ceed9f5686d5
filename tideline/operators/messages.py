"""Keyed messages from row events: upserts, tombstones, dropped unkeyed deletes, partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import partition_column


def to_messages(log: DataFrame, key: Column, value: Column, topic: Column, partitions: int | None = None) -> DataFrame:
    """``topic, key, value, xid, lsn, seq`` and ``partition`` if asked for.

    Inserts and updates carry the new row, deletes a null value. A delete without a key
    says nothing to a reader of the topic and is left out. Begin, commit and schema
    events are not messages.
    """
    rows = log.filter(F.col("kind").isin("insert", "update", "delete"))
    rows = rows.filter(key.isNotNull() | (F.col("kind") != "delete"))
    out = rows.select(
        topic.alias("topic"),
        key.alias("key"),
        F.when(F.col("kind") != "delete", value).alias("value"),
        "xid",
        "lsn",
        "seq",
    )
    if partitions:
        # A struct key is hashed through its JSON text, an encoded one through its bytes.
        hashed = F.col("key") if dict(out.dtypes)["key"] in ("binary", "string") else F.to_json("key", {"ignoreNullFields": "false"})
        hashed = F.when(F.col("key").isNotNull(), hashed)
        out = out.withColumn("partition", partition_column(hashed, partitions, [F.col("lsn"), F.col("seq")]))
    return out


def deduplicate(messages: DataFrame) -> DataFrame:
    """One message per (topic, lsn, seq): what at-least-once delivery repeated is dropped."""
    return messages.dropDuplicates(["topic", "lsn", "seq"])


def in_order(messages: DataFrame, one_task: bool = False) -> DataFrame:
    """All messages of a key in one task, in log order; no order across keys is made, and unkeyed ones are spread.

    Messages that lie in ``one_task`` already are not moved.
    """
    if not one_task:
        spread = F.when(F.col("key").isNull(), F.xxhash64("lsn", "seq"))
        messages = messages.repartition("topic", "key", spread)
    return messages.sortWithinPartitions("topic", "key", "lsn", "seq")


def debug_lines(log: DataFrame, table: Column, key: Column, old: Column, new: Column) -> DataFrame:
    """A readable line per event, old rows included: ``lsn, seq, line``."""
    part = lambda label, c: F.when(c.isNotNull(), F.concat(F.lit(label), c)).otherwise(F.lit(""))
    line = (
        F.when(F.col("kind") == "begin", F.concat(F.lit("begin xid="), F.col("xid")))
        .when(F.col("kind") == "commit", F.concat(F.lit("commit xid="), F.col("xid")))
        .when(F.col("kind") == "schema", F.concat(F.lit("schema "), table))
        .otherwise(F.concat(F.col("kind"), F.lit(" "), table, part(" key=", key), part(" old=", old), part(" new=", new)))
    )
    return log.select("lsn", "seq", line.alias("line"))
