"""Folding a change log or topic into current state: the latest value per key, deletes gone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, key: list[str], order: Column, deleted: Column, keep: list[str]) -> DataFrame:
    """``key`` and ``keep`` of the last event of each key, unless that event is a delete.

    A maximum over structs is an aggregate with map-side partials: a key that a third of
    all events share reaches its reducer as one row a task. Sorting is local, by key, before
    the exchange; unlike a ranking window, no task orders all events of a key.
    """
    state = F.struct(deleted.alias("gone"), *[F.col(c) for c in keep])
    last = log.groupBy(*key).agg(F.max_by(state, order).alias("__s"))
    return last.filter(~F.col("__s.gone")).select(*key, *[F.col(f"__s.{c}").alias(c) for c in keep])


def compact_messages(messages: DataFrame) -> DataFrame:
    """Current value of each (topic, key); unkeyed messages cannot be compacted and are left out."""
    keyed = messages.filter(F.col("key").isNotNull())
    order = F.struct("lsn", "seq")
    return latest(keyed, ["topic", "key"], order, F.col("value").isNull(), ["value", "lsn", "seq"])
