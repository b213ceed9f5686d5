"""The replication job: a snapshot once, then the log, into a topic sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.avro import schema_prefix
from ..functions.naming import topic_name
from ..functions.wire import key_schema, row_schema, schema_json
from ..policy import MAX_ROW_BYTES, ErrorPolicy, handle
from ..registry import Registry
from ..sources.catalog import Table, CatalogError
from ..sources.snapshot import encoded_snapshot
from .publish import EventPublisher, typed_messages
from .sinks import TopicSink, batch_writer


@dataclass
class Job:
    """What to copy and where. ``form`` is avro or json; a registry goes with avro only."""

    sink: TopicSink
    checkpoint: str
    form: str = "avro"
    registry: Registry | None = None
    topic_prefix: str | None = None
    allow_unkeyed: bool = False
    policy: ErrorPolicy = ErrorPolicy.EXIT
    max_row_bytes: int = MAX_ROW_BYTES
    known_topics: set[str] | None = None
    schema_ids: dict[str, tuple[int | None, int | None]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.form not in ("avro", "json"):
            raise ValueError(f"output format must be avro or json, not {self.form!r}")
        if self.form == "json" and self.registry is not None:
            raise ValueError("a schema registry cannot be used with JSON output")

    # ------------------------------------------------------------ snapshot

    def topic(self, table: Table) -> str:
        return topic_name(table.name, table.namespace, self.topic_prefix)

    def register(self, table: Table, df: DataFrame) -> tuple[int | None, int | None]:
        """Ids of the table's key and row schema, registered on first use or change."""
        if self.registry is None:
            return None, None
        topic = self.topic(table)
        key = schema_json(key_schema(table.key_index, df.schema, table.key, table.namespace)) if table.key else None
        self.schema_ids[topic] = self.registry.register_table(topic, key, schema_json(row_schema(table.name, df.schema, table.namespace)))
        return self.schema_ids[topic]

    def snapshot_messages(self, read: Callable[[str], DataFrame], table: Table) -> DataFrame:
        """The table's rows as messages at position 0; ``seq`` tells equal rows apart and survives retries."""
        df = read(table.name)
        key_id, row_id = self.register(table, df)
        rows = encoded_snapshot(df, table, self.form)
        key, value = F.col("key"), F.col("value")
        if row_id is not None:
            value = schema_prefix(row_id, value)
            key = schema_prefix(key_id, key) if key_id is not None else key
        return rows.select(
            F.lit(self.topic(table)).alias("topic"), key.alias("key"), value.alias("value"),
            F.lit(0).cast("long").alias("xid"), F.lit(0).cast("long").alias("lsn"),
            F.monotonically_increasing_id().alias("seq"),
        )

    def snapshot(self, read: Callable[[str], DataFrame], tables: list[Table]) -> int:
        """Publish all rows of all tables as batch -1 and return how many tables were published.

        Unkeyed tables stop the snapshot unless allowed. Under the log policy a table that
        cannot be read or registered is skipped. A snapshot that stops takes back what it has
        published, as far as the sink can.
        """
        if not self.allow_unkeyed and (loose := [t.name for t in tables if not t.key]):
            raise CatalogError(f"tables without a key: {', '.join(loose)}; allow unkeyed tables or give them a key")
        done = 0
        write = batch_writer(self.sink, self.policy, self.max_row_bytes, self.known_topics)
        begun: list[str] = []
        spark = SparkSession.active()
        for table in tables:
            try:
                begun.append(self.topic(table))
                write(self.snapshot_messages(read, table), -1)
                done += 1
            except Exception as e:  # noqa: BLE001  the policy decides about any fault of a table
                if self.policy is ErrorPolicy.EXIT:
                    self.sink.discard(spark, begun, -1)
                handle(e, self.policy, f"snapshot of {table.name}")
        return done

    # ------------------------------------------------------------ stream

    def stream(self, messages: DataFrame, start_lsn: int = 0, trigger: dict | None = None) -> StreamingQuery:
        """Publish a streaming frame of messages after ``start_lsn``; restarts resume from the checkpoint."""
        write = batch_writer(self.sink, self.policy, self.max_row_bytes, self.known_topics)
        def publish(batch: DataFrame, batch_id: int) -> None:
            write(batch, batch_id, _one_task(batch))

        return self._start(messages.filter(F.col("lsn") > start_lsn), publish, trigger)

    def _start(self, rows: DataFrame, publish: Callable[[DataFrame, int], None], trigger: dict | None) -> StreamingQuery:
        writer = rows.writeStream.option("checkpointLocation", self.checkpoint).trigger(**(trigger or {"availableNow": True}))
        with _plain_renames(rows.sparkSession, self.checkpoint):
            return writer.foreachBatch(publish).start()

    def stream_table(self, log: DataFrame, table: Table, start_lsn: int = 0, trigger: dict | None = None) -> StreamingQuery:
        """Publish a streaming typed log of one table: rows checked, key changes split, keys and rows encoded."""
        row = log.schema["new"].dataType
        ids = (None, None)
        if self.registry is not None:
            key = schema_json(key_schema(table.key_index, row, table.key, table.namespace)) if table.key else None
            ids = self.registry.register_table(self.topic(table), key, schema_json(row_schema(table.name, row, table.namespace)))
        return self.stream(typed_messages(log, table, self.topic(table), self.form, ids, self.policy), start_lsn, trigger)

    def stream_events(self, events: DataFrame, start_lsn: int = 0, trigger: dict | None = None) -> StreamingQuery:
        """Publish a streaming event log of many tables (see :class:`EventPublisher`) after ``start_lsn``.

        Schema events before that position still count, as rows after it are encoded by them. Dead
        letters are logged by number.
        """
        publisher = EventPublisher(f"{self.checkpoint}/relations", self.form, self.registry, self.topic_prefix, self.policy)
        write = batch_writer(self.sink, self.policy, self.max_row_bytes, self.known_topics)

        after = F.col("lsn") > start_lsn

        def publish(batch: DataFrame, batch_id: int) -> None:
            one_task = _one_task(batch)
            batch.persist()  # read once for its schema events and its rows
            try:
                messages, dead = publisher.messages(batch, batch_id)
                write(messages.filter(after), batch_id, one_task and publisher.in_place)
                if self.policy is ErrorPolicy.LOG:
                    for row in dead.groupBy("error").count().orderBy("error").limit(100).collect():
                        handle(ValueError(f"{row['error']} ({row['count']} rows)"), self.policy, "dead letters")
            finally:
                batch.unpersist()

        return self._start(events, publish, trigger)

    # ------------------------------------------------------------ positions

    def save_position(self, spark: SparkSession, lsn: int) -> None:
        """Keep the log position that the snapshot belongs to, for this start and all restarts."""
        spark.createDataFrame([(lsn,)], "lsn long").coalesce(1).write.mode("overwrite").parquet(f"{self.checkpoint}/snapshot")

    def position(self, spark: SparkSession) -> int:
        """The position kept by :meth:`save_position`, or 0."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.checkpoint}/snapshot/_SUCCESS")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return 0
        return spark.read.schema("lsn long").parquet(f"{self.checkpoint}/snapshot").first()["lsn"]

    def has_checkpoint(self, spark: SparkSession) -> bool:
        """True if an earlier run left a position to resume from (then no snapshot is taken)."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.checkpoint}/offsets")
        return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))

    def drop_checkpoint(self, spark: SparkSession) -> None:
        """Forget the position: what a failed first snapshot does before it is tried again."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.checkpoint)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"


@contextmanager
def _plain_renames(spark: SparkSession, checkpoint: str) -> Iterator[None]:
    """Let a query started here rename checkpoint files plainly if they are on a local disk.

    Spark's other way looks for links first, with a process of its own for every look: some 40 ms a batch.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    local = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"
    if not local or spark.conf.get(CHECKPOINT_FILES, None) is not None:
        yield
        return
    spark.conf.set(CHECKPOINT_FILES, "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    try:
        yield  # the query has its own copy of the settings from its start on
    finally:
        spark.conf.unset(CHECKPOINT_FILES)


def _one_task(batch: DataFrame) -> bool:
    """Whether a micro-batch was read by one task, as small ones are: its order need not be made by a shuffle."""
    return batch._jdf.queryExecution().toRdd().getNumPartitions() == 1


def drain(start: Callable[[], StreamingQuery]) -> int:
    """Start a query again and again until its source has nothing more, and count the starts that read something.

    A Python source is asked for one end a start under ``availableNow``, so a start reads one batch of
    ``maxTransactions``. Each start resumes from the checkpoint.
    """
    done = 0
    while True:
        query = start()
        query.awaitTermination()
        if not any(p["numInputRows"] for p in query.recentProgress):
            return done
        done += 1


def follow(start: Callable[[dict], StreamingQuery]) -> None:
    """Start a query once, with the trigger it is given, let it read one batch after another until its source has nothing more, and stop it.

    One start reads all batches, of the source's ``maxTransactions`` each, where :func:`drain` needs one a batch. A
    source that gets rows faster than they are read never ends.
    """
    query = start({"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run(
    spark: SparkSession, job: Job, read: Callable[[str], DataFrame], tables: list[Table],
    messages: DataFrame | None = None, start_lsn: int = 0, skip_snapshot: bool = False,
    log_end: Callable[[], int] | None = None, events: DataFrame | None = None, trigger: dict | None = None,
) -> StreamingQuery | None:
    """Snapshot (on the first start, unless skipped), then the stream if there is one.

    ``log_end`` tells the log's position: it is asked before the snapshot and kept, and the
    stream starts after it, so that no change is missed and none before it is sent again. The stream is of
    ready ``messages`` or of ``events``.
    """
    if not skip_snapshot and not job.has_checkpoint(spark):
        try:
            if log_end is not None:
                job.save_position(spark, log_end())
            job.snapshot(read, tables)
        except Exception:
            job.drop_checkpoint(spark)
            raise
    start_lsn = max(start_lsn, job.position(spark))
    if events is not None:
        return job.stream_events(events, start_lsn, trigger)
    return None if messages is None else job.stream(messages, start_lsn, trigger)
