"""Transactions: summaries, begin/commit validation, the durable checkpoint, and what is in flight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_IN_FLIGHT = 1000
BUCKETS = 4096


def summary(log: DataFrame, acked: Column | None = None) -> DataFrame:
    """Per transaction: row events, unacknowledged ones, first and last position, commit position.

    ``commit_lsn`` is the commit event's position where the log has commit events, else
    the last row's.
    """
    row = F.col("kind").isin("insert", "update", "delete")
    open_ = F.lit(False) if acked is None else ~F.coalesce(acked, F.lit(False))
    return log.groupBy("xid").agg(
        F.count(F.when(row, 1)).alias("events"),
        F.count(F.when(row & open_, 1)).alias("pending"),
        F.min("lsn").alias("first_lsn"),
        F.max("lsn").alias("last_lsn"),
        F.coalesce(F.max(F.when(F.col("kind") == "commit", F.col("lsn"))), F.max("lsn")).alias("commit_lsn"),
    )


def brackets(log: DataFrame) -> DataFrame:
    """``xid, fault`` of transactions whose begin and commit do not match."""
    marks = log.groupBy("xid").agg(
        F.count(F.when(F.col("kind") == "begin", 1)).alias("begins"),
        F.count(F.when(F.col("kind") == "commit", 1)).alias("commits"),
        F.min(F.when(F.col("kind") == "begin", F.struct("lsn", "seq"))).alias("b"),
        F.max(F.when(F.col("kind") == "commit", F.struct("lsn", "seq"))).alias("c"),
    )
    fault = (
        F.when(F.col("begins") != 1, F.format_string("%d begin events", F.col("begins")))
        .when(F.col("commits") > 1, F.format_string("%d commit events", F.col("commits")))
        .when(F.col("commits") == 0, F.lit("no commit"))
        .when(F.col("c") < F.col("b"), F.lit("commit before begin"))
    )
    return marks.withColumn("fault", fault).filter("fault is not null").select("xid", "fault")


def checkpoint(transactions: DataFrame) -> DataFrame:
    """One row: the last commit position before which every transaction is fully acknowledged.

    Two aggregates (the earliest pending transaction, then the last commit before it)
    instead of an ordered pass, so no task sees all transactions. Null if none is durable.
    """
    barrier = transactions.agg(F.min(F.when(F.col("pending") > 0, F.col("commit_lsn"))).alias("barrier"))
    before = F.col("commit_lsn") < F.coalesce(barrier.scalar(), F.lit(2**63 - 1))
    return transactions.agg(F.max(F.when(before, F.col("commit_lsn"))).alias("checkpoint_lsn"))


def running_total(df: DataFrame, order: str, value: Column, out: str, buckets: int = BUCKETS) -> DataFrame:
    """Running sum of ``value`` by ascending ``order`` (a unique integer), without one task for all rows.

    The order range is cut into at most ``buckets`` even parts. Each part is summed by
    itself; only the parts' totals are accumulated in one place.
    """
    span = df.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    low, high = (span["low"] or 0), (span["high"] or 0)
    width = max(1, -(-(high - low + 1) // buckets))
    parts = df.withColumn("__part", F.floor((F.col(order) - low) / width)).withColumn("__v", value)
    totals = parts.groupBy("__part").agg(F.sum("__v").alias("__t"))
    # One row per part: at most ``buckets``, both in the window and in the broadcast.
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__part", F.coalesce(F.sum("__t").over(ahead), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = parts.join(F.broadcast(totals), "__part")
    return joined.withColumn(out, F.sum("__v").over(inside) + F.col("__before")).drop("__part", "__v", "__before")


def in_flight(transactions: DataFrame) -> DataFrame:
    """Per transaction, how many are not yet retired when it commits, itself included.

    Transactions retire in order, so nothing after the first pending one has retired.
    """
    barrier = transactions.agg(F.min(F.when(F.col("pending") > 0, F.col("commit_lsn"))).alias("b")).scalar()
    stuck = F.when(F.col("commit_lsn") >= F.coalesce(barrier, F.lit(2**63 - 1)), 1).otherwise(0)
    out = running_total(transactions, "commit_lsn", stuck, "__stuck")
    return out.withColumn("in_flight", F.greatest(F.col("__stuck"), F.lit(1)).cast("long")).drop("__stuck")


def over_limit(flights: DataFrame, limit: int = MAX_IN_FLIGHT) -> DataFrame:
    """Transactions at which a source with this limit would have had to wait."""
    return flights.filter(F.col("in_flight") > limit)
