"""Assembling whole transactions from a stream, by keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SUMMARY = "xid long, events long, first_lsn long, commit_lsn long, fault string"


class TransactionTracker(StatefulProcessor):
    """Counts the events of each xid and emits a row when its commit has been seen.

    A second begin, or a commit without begin, is reported in ``fault``. Events of a
    transaction may be spread over micro-batches.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("txn", "begins long, events long, first_lsn long, commit_lsn long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        begins, events, first, commit = self.state.get() if self.state.exists() else (0, 0, None, None)
        for pdf in rows:
            begins += int((pdf["kind"] == "begin").sum())
            events += int(pdf["kind"].isin(["insert", "update", "delete"]).sum())
            low = int(pdf["lsn"].min())
            first = low if first is None else min(first, low)
            ends = pdf.loc[pdf["kind"] == "commit", "lsn"]
            if len(ends):
                commit = max(int(ends.max()), commit or 0)
        if commit is None:
            self.state.update((begins, events, first, commit))
            return
        self.state.clear()
        fault = None if begins == 1 else f"{begins} begin events"
        yield pd.DataFrame(
            {"xid": [int(key[0])], "events": [events], "first_lsn": [first], "commit_lsn": [commit], "fault": [fault]}
        )

    def close(self) -> None:
        pass


def complete_transactions(log: DataFrame) -> DataFrame:
    """``xid, events, first_lsn, commit_lsn, fault`` of each transaction once it has committed.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    return (
        log.select("xid", "lsn", "kind")
        .groupBy("xid")
        .transformWithStateInPandas(
            statefulProcessor=TransactionTracker(), outputStructType=SUMMARY, outputMode="Append", timeMode="None"
        )
    )
