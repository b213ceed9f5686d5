"""Callbacks for a change stream: one method for each kind of event, given a batch of such events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from pyspark.sql.streaming import StreamingQueryListener

from ..policy import ErrorPolicy, handle


class Handler:
    """Override what is of interest; each method gets the batch's events of its kind as a frame.

    Within a batch, kinds come in the order schema, begin, insert, update, delete, commit; the
    order of single events is in ``(lsn, seq)``. ``keepalive`` is called for a batch without events.
    """

    ORDER = ("schema", "begin", "insert", "update", "delete", "commit")

    def on_begin(self, events: DataFrame, batch_id: int) -> None: ...

    def on_commit(self, events: DataFrame, batch_id: int) -> None: ...

    def on_schema(self, events: DataFrame, batch_id: int) -> None: ...

    def on_insert(self, events: DataFrame, batch_id: int) -> None: ...

    def on_update(self, events: DataFrame, batch_id: int) -> None: ...

    def on_delete(self, events: DataFrame, batch_id: int) -> None: ...

    def on_keepalive(self, batch_id: int) -> None: ...

    def on_error(self, error: Exception, batch_id: int) -> None: ...


def dispatch(handler: Handler, policy: ErrorPolicy = ErrorPolicy.EXIT) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. Methods that are not overridden cost nothing."""
    wanted = [k for k in Handler.ORDER if getattr(type(handler), f"on_{k}") is not getattr(Handler, f"on_{k}")]

    def call(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            found = {r[0] for r in batch.select("kind").distinct().collect()}  # six kinds at most
            if not found:
                handler.on_keepalive(batch_id)
            for kind in wanted:
                if kind in found:
                    try:
                        getattr(handler, f"on_{kind}")(batch.filter(batch["kind"] == kind), batch_id)
                    except Exception as e:  # noqa: BLE001  the policy decides about any fault of a callback
                        handler.on_error(e, batch_id)
                        handle(e, policy, f"{kind} events of batch {batch_id}")
        finally:
            batch.unpersist()

    return call


class Keepalive(StreamingQueryListener):
    """Calls ``on_keepalive`` while a query has nothing to read: an idle source makes no batch.

        spark.streams.addListener(Keepalive(handler))

    The batch number given is -1, as there is none.
    """

    def __init__(self, handler: Handler):
        self.handler = handler

    def onQueryStarted(self, event: object) -> None: ...

    def onQueryProgress(self, event: object) -> None: ...

    def onQueryTerminated(self, event: object) -> None: ...

    def onQueryIdle(self, event: object) -> None:
        self.handler.on_keepalive(-1)
