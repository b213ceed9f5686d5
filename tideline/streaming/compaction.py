"""Streaming compaction: the current value per key, kept as native aggregation state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest_stream(log: DataFrame, key: list[str], order: Column, deleted: Column, keep: list[str]) -> DataFrame:
    """Streaming form of :func:`tideline.operators.compact.latest`, tombstones included.

    The state of a key is one struct, updated by a maximum over (order, row), so replayed or late
    events change nothing: order is the log's, not the clock's, and needs no watermark.
    """
    state = F.struct(order.alias("at"), deleted.alias("gone"), *[F.col(c) for c in keep])
    return log.groupBy(*key).agg(F.max(state).alias("state"))


def write_changes(state: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append each micro-batch's changed keys under ``path/batch=N``; a repeated batch replaces itself."""

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def current_state(changes: DataFrame, key: list[str], keep: list[str]) -> DataFrame:
    """Live rows from the changes that :func:`write_changes` has written."""
    last = changes.groupBy(*key).agg(F.max("state").alias("state"))
    return last.filter(~F.col("state.gone")).select(*key, *[F.col(f"state.{c}").alias(c) for c in keep])
