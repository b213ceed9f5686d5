"""Topic sinks for ``foreachBatch``: Parquet folders, Kafka where its connector exists, or the console."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.messages import deduplicate, in_order
from ..policy import ErrorPolicy, apply_policy, handle, or_fail, row_fault


class TopicSink(ABC):
    @abstractmethod
    def write(self, messages: DataFrame, batch_id: int) -> None:
        """Make a batch durable. Returning is the acknowledgement of all its messages."""

    def write_task(self, messages: DataFrame, batch_id: int) -> None:
        """The same for messages that all lie in one task, as those of a small batch do."""
        self.write(messages, batch_id)

    def discard(self, spark: SparkSession, topics: list[str], batch_id: int) -> None:
        """Take back what a batch has published of these topics, where the sink can."""


class FolderSink(TopicSink):
    """One folder a topic, one sub-folder a batch.

    Writing a batch again replaces what its first attempt wrote, and readers drop repeated
    (topic, lsn, seq), so at-least-once delivery is seen once.
    """

    def __init__(self, path: str, by_key: bool = True, options: dict[str, str] | None = None):
        self.path, self.by_key, self.options = path.rstrip("/"), by_key, options or {}

    def write(self, messages: DataFrame, batch_id: int) -> None:
        self._write(in_order(messages) if self.by_key else messages, batch_id)

    def write_task(self, messages: DataFrame, batch_id: int) -> None:
        self._write(in_order(messages, one_task=True) if self.by_key else messages, batch_id)

    def _write(self, messages: DataFrame, batch_id: int) -> None:
        # A text, as a number is a part of the generated code, which would be compiled again for every batch; it names a folder only.
        stamped = messages.withColumn("batch", F.lit(str(batch_id)))
        (
            stamped.write.mode("overwrite")
            .options(**self.options)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "batch")
            .parquet(self.path)
        )

    def discard(self, spark: SparkSession, topics: list[str], batch_id: int) -> None:
        for topic in topics:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/topic={topic}/batch={batch_id}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, spark: SparkSession) -> DataFrame:
        return deduplicate(spark.read.parquet(self.path))


class KafkaSink(TopicSink):
    """Through the Kafka connector, which must be on the class path."""

    def __init__(self, servers: str = "localhost:9092", options: dict[str, str] | None = None):
        self.servers, self.options = servers, options or {}

    def write(self, messages: DataFrame, batch_id: int) -> None:
        numbered = ["partition"] if "partition" in messages.columns else []
        out = messages.select("topic", F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), *numbered)
        writer = out.write.format("kafka").option("kafka.bootstrap.servers", self.servers)
        for k, v in self.options.items():
            writer = writer.option(f"kafka.{k}", v)
        try:
            writer.save()
        except AnalysisException as e:
            raise RuntimeError("the Kafka connector is not on the class path") from e


class ConsoleSink(TopicSink):
    """A readable line for each message, in log order; at most ``rows`` of a batch."""

    def __init__(self, rows: int = 1000):
        self.rows = rows

    def write(self, messages: DataFrame, batch_id: int) -> None:
        shown = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(
            F.hex(c) if dict(messages.dtypes)[c] == "binary" else F.col(c).cast("string")
        )
        line = F.concat_ws(" ", F.concat(F.lit("xid="), "xid"), F.concat(F.lit("lsn="), "lsn"), "topic",
                           F.concat(F.lit("key="), shown("key")), F.concat(F.lit("value="), shown("value")))
        for row in in_order(messages).select("lsn", "seq", line.alias("line")).orderBy("lsn", "seq").limit(self.rows).collect():
            print(row["line"])


def batch_writer(
    sink: TopicSink, policy: ErrorPolicy = ErrorPolicy.EXIT, max_row_bytes: int = 1 << 20, known_topics: set[str] | None = None
):
    """A ``foreachBatch`` function that applies the error policy and writes.

    Faults are oversize values and, where ``known_topics`` is given, topics that do not
    exist. Under ``log`` faulty rows go to the log by number and the batch goes on. ``one_task`` says
    that the messages all lie in one task.
    """
    # Columns are made once, as each costs about as much as a small batch's rows.
    fault = row_fault(F.col("value").cast("binary"), max_row_bytes)
    if known_topics is not None:
        missing = F.when(~F.col("topic").isin(*known_topics), F.concat(F.lit("unknown topic "), F.col("topic")))
        fault = F.coalesce(missing, fault)
    sound = or_fail(fault)

    def write(messages: DataFrame, batch_id: int, one_task: bool = False) -> None:
        put = sink.write_task if one_task else sink.write
        if policy is ErrorPolicy.EXIT:
            put(messages.filter(sound), batch_id)
            return
        fine, bad = apply_policy(messages, fault, policy)
        put(fine, batch_id)
        if policy is ErrorPolicy.LOG:
            for row in bad.groupBy("topic", "error").count().orderBy("topic", "error").limit(100).collect():
                handle(ValueError(f"{row['error']} ({row['count']} rows)"), policy, row["topic"])

    return write
