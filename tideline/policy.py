"""Error policy: stop at a row that cannot be published, or set it aside and go on."""

from __future__ import annotations

import enum
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("tideline")
MAX_ROW_BYTES = 1 << 20


class ErrorPolicy(enum.Enum):
    EXIT = "exit"
    LOG = "log"

    @classmethod
    def parse(cls, text: str) -> ErrorPolicy:
        for policy in cls:
            if text == policy.value:
                return policy
        raise ValueError(f"error policy must be log or exit, not {text!r}")


class PublishError(RuntimeError):
    pass


def row_fault(value: Column, max_bytes: int = MAX_ROW_BYTES) -> Column:
    """Reason why an encoded row cannot be sent, or null."""
    size = F.octet_length(value)
    return F.when(size > max_bytes, F.format_string("row of %d bytes, at most %d are allowed", size, F.lit(max_bytes)))


def or_fail(fault: Column) -> Column:
    """A condition that is true or fails the query: the ``exit`` policy.

    It is a predicate over the very rows that are published, so it cannot be pruned away.
    """
    return F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(fault).cast("boolean"))


def apply_policy(rows: DataFrame, fault: Column, policy: ErrorPolicy = ErrorPolicy.EXIT) -> tuple[DataFrame, DataFrame]:
    """(rows to publish, rows set aside with an ``error`` column).

    Under ``exit`` a faulty row fails the query when it is met, without a pass of its
    own; under ``log`` it is set aside and counts as handled, so checkpoints move on.
    """
    marked = rows.withColumn("error", fault)
    if policy is ErrorPolicy.EXIT:
        return rows.filter(or_fail(fault)), marked.limit(0)
    return marked.filter(F.col("error").isNull()).drop("error"), marked.filter(F.col("error").isNotNull())


def dead_letters(events: DataFrame, known: DataFrame, key: str = "relid") -> DataFrame:
    """Events whose ``key`` is not in ``known``: lookups that fail. Null keys fail too."""
    return events.join(known.select(key).distinct(), key, "left_anti")


def handle(error: Exception, policy: ErrorPolicy, what: str) -> None:
    """Raise or log, as the policy says."""
    if policy is ErrorPolicy.EXIT:
        raise PublishError(f"{what}: {error}") from error
    log.warning("%s: %s", what, error)
