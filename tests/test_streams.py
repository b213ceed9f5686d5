"""The change-log source, sinks, streaming state and the replication job, restarts included."""

import pytest
from pyspark.sql import functions as F

from tideline.cli import make_registry, make_sink, parse, table_names
from tideline.operators import compact, log
from tideline.policy import ErrorPolicy, PublishError
from tideline.registry import MemoryRegistry
from tideline.sources.catalog import CatalogError, Table
from tideline.sources.changelog import OptionError, StreamReader, _Log, register
from tideline.streaming.compaction import current_state, latest_stream, write_changes
from tideline.streaming.handlers import Handler, dispatch
from tideline.streaming.replicate import Job, run
from tideline.streaming.sinks import ConsoleSink, FolderSink, KafkaSink, batch_writer
from tideline.streaming.transactions import complete_transactions

SCHEMA = "lsn long, seq int, xid long, kind string, key string, value string"


def events(n, start=1):
    return [(k, 0, (k - 1) // 4 + 1, "delete" if k % 7 == 0 else "insert", str(k % 5), None if k % 7 == 0 else f"v{k}") for k in range(start, start + n)]


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame(events(21), SCHEMA).repartition(3).write.parquet(path)
    register(spark)
    return path


def test_batch_source(spark, folder):
    got = spark.read.format("changelog").schema(SCHEMA).option("path", folder).load()
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame(events(21), SCHEMA).collect()))
    later = spark.read.format("changelog").schema(SCHEMA).option("path", folder).option("startingOffset", "10").load()
    assert later.agg(F.min("lsn"), F.count("*")).first() == (11, 11)


def test_offsets_end_at_transactions(spark, folder):
    schema = spark.read.parquet(folder).schema
    reader = StreamReader(_Log({"path": folder, "maxTransactions": "2"}, schema))
    assert reader.initialOffset() == {"lsn": -1}
    assert [reader.latestOffset()["lsn"] for _ in range(4)] == [8, 16, 21, 21]
    assert reader.partitions({"lsn": 8}, {"lsn": 8}) == []
    with pytest.raises(OptionError):
        _Log({}, schema)
    with pytest.raises(OptionError):
        _Log({"path": "x", "partitions": "no"}, schema)


def stream(spark, folder):
    return spark.readStream.format("changelog").schema(SCHEMA).option("path", folder).load()


def test_stream_and_restart(spark, folder, tmp_path):
    sink = FolderSink(str(tmp_path / "topics"))
    job = Job(sink, str(tmp_path / "ckpt"), form="json")

    def messages():
        return stream(spark, folder).select(F.lit("t").alias("topic"), "key", "value", "xid", "lsn", F.col("seq").cast("long").alias("seq"))

    assert not job.has_checkpoint(spark)
    job.stream(messages()).awaitTermination()
    assert sink.read(spark).count() == 21 and job.has_checkpoint(spark)
    spark.createDataFrame(events(6, 22), SCHEMA).write.mode("append").parquet(folder)
    job.stream(messages()).awaitTermination()
    got = sink.read(spark)
    assert sorted(r["lsn"] for r in got.collect()) == list(range(1, 28))
    # A batch delivered again is seen once.
    sink.write(got.filter("lsn <= 5").select("topic", "key", "value", "xid", "lsn", "seq"), 77)
    assert sink.read(spark).count() == 27
    job.drop_checkpoint(spark)
    assert not job.has_checkpoint(spark)


def test_streaming_compaction_equals_batch(spark, folder, tmp_path):
    def step():
        state = latest_stream(stream(spark, folder), ["key"], log.position(), F.col("kind") == "delete", ["value"])
        write_changes(state, str(tmp_path / "changes"), str(tmp_path / "c")).awaitTermination()
        return current_state(spark.read.parquet(str(tmp_path / "changes" / "*")), ["key"], ["value"])

    def batch():
        return compact.latest(spark.read.parquet(folder), ["key"], log.position(), F.col("kind") == "delete", ["value"])

    assert sorted(map(tuple, step().collect())) == sorted(map(tuple, batch().collect()))
    spark.createDataFrame(events(9, 22), SCHEMA).write.mode("append").parquet(folder)
    assert sorted(map(tuple, step().collect())) == sorted(map(tuple, batch().collect()))


def test_transaction_tracker(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(1, 0, 1, "begin", None, None), (2, 0, 1, "insert", "a", "x"), (3, 0, 1, "commit", None, None), (4, 0, 2, "begin", None, None), (5, 0, 2, "insert", "b", "y")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    register(spark)

    def step():
        done = complete_transactions(stream(spark, path))
        query = done.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(
            lambda df, b: df.write.mode("overwrite").parquet(str(tmp_path / "out" / f"b={b}"))
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(tuple(r)[:5] for r in spark.read.parquet(str(tmp_path / "out")).select("xid", "events", "first_lsn", "commit_lsn", "fault").collect())

    assert step() == [(1, 1, 1, 3, None)]
    spark.createDataFrame([(6, 0, 2, "delete", "b", None), (7, 0, 2, "commit", None, None), (8, 0, 3, "commit", None, None)], SCHEMA).write.mode("append").parquet(path)
    assert step() == [(1, 1, 1, 3, None), (2, 2, 4, 7, None), (3, 0, 8, 8, "0 begin events")]


@pytest.mark.parametrize("form", ["avro", "json"])
def test_replication(spark, tmp_path, form):
    users = spark.createDataFrame([(k, f"user{k}") for k in range(1, 11)], "id int, username string")
    notes = spark.createDataFrame([("n",)], "message string")
    read = {"users": users, "notes": notes}.__getitem__
    registry = MemoryRegistry() if form == "avro" else None
    sink = FolderSink(str(tmp_path / "topics"))
    job = Job(sink, str(tmp_path / "ckpt"), form, registry, "pre")
    tables = [Table(1, "users", ["id"]), Table(2, "notes")]
    with pytest.raises(CatalogError, match="notes"):
        run(spark, job, read, tables)
    job.allow_unkeyed = True
    run(spark, job, read, tables)
    got = sink.read(spark)
    assert {r["topic"]: r["count"] for r in got.groupBy("topic").count().collect()} == {"pre.users": 10, "pre.notes": 1}
    if registry:
        assert set(registry.subjects) == {"pre.users-key", "pre.users-value", "pre.notes-value"}
        assert bytes(got.filter("topic = 'pre.users'").first()["value"])[:5].hex() == "0000000002"
    with pytest.raises(ValueError):
        Job(sink, "c", "json", MemoryRegistry())
    with pytest.raises(ValueError):
        Job(sink, "c", "xml")


def test_policies_of_a_sink(spark, tmp_path, caplog):
    rows = spark.createDataFrame([("t", "1", "ok"), ("t", "2", "x" * 3000), ("u", "3", "ok")], "topic string, key string, value string")
    rows = rows.selectExpr("*", "1L AS xid", "1L AS lsn", "cast(key AS long) AS seq")
    sink = FolderSink(str(tmp_path / "topics"))
    with pytest.raises(Exception, match="row of 3000 bytes"):
        batch_writer(sink, ErrorPolicy.EXIT, 1000)(rows, 0)
    batch_writer(sink, ErrorPolicy.LOG, 1000, {"t"})(rows, 1)
    assert [r["key"] for r in sink.read(spark).collect()] == ["1"]
    assert "unknown topic u" in caplog.text and "row of 3000 bytes" in caplog.text
    job = Job(sink, str(tmp_path / "c"), "json", policy=ErrorPolicy.EXIT)
    with pytest.raises(PublishError):
        job.snapshot(lambda n: spark.read.parquet(str(tmp_path / "missing")), [Table(1, "gone", ["id"])])
    job.policy = ErrorPolicy.LOG
    assert job.snapshot(lambda n: spark.read.parquet(str(tmp_path / "missing")), [Table(1, "gone", ["id"])]) == 0


def test_command_line(spark, tmp_path, capsys):
    args = parse(["-d", "x", "-u", "-p", "pre", "-e", "log", "-C", "a=b=c", "-k", "t=a,b", "-f", "json"])
    assert args.allow_unkeyed and args.topic_prefix == "pre" and args.sink_config == [("a", "b=c")] and args.key == [("t", "a,b")]
    for bad in ([], ["-d", "x", "-e", "maybe"], ["-d", "x", "-f", "json", "-r", "http://r"], ["-d", "x", "-C", "novalue"]):
        with pytest.raises(SystemExit):
            parse(bad)
    assert isinstance(make_sink("console", {}), ConsoleSink) and isinstance(make_sink("folder:/x", {}), FolderSink)
    assert isinstance(make_sink("kafka:h:1", {}), KafkaSink) and make_registry(None) is None
    with pytest.raises(ValueError):
        make_sink("pigeon", {})
    for n in ("users", "orders"):
        spark.range(1).write.parquet(str(tmp_path / f"{n}.parquet"))
    assert table_names(spark, str(tmp_path), "%") == ["orders", "users"] and table_names(spark, str(tmp_path), "u%") == ["users"]
    with pytest.raises(RuntimeError, match="Kafka connector"):
        KafkaSink().write(spark.createDataFrame([("t", "k", "v")], "topic string, key string, value string"), 0)


class Counting(Handler):
    def __init__(self):
        self.seen, self.idle, self.errors = [], 0, []

    def on_insert(self, events, batch_id):
        self.seen.append(("insert", events.count()))

    def on_delete(self, events, batch_id):
        raise ValueError("no deletes here")

    def on_keepalive(self, batch_id):
        self.idle += 1

    def on_error(self, error, batch_id):
        self.errors.append(str(error))


def test_handlers(spark):
    rows = spark.createDataFrame(events(21), SCHEMA)
    handler = Counting()
    call = dispatch(handler, ErrorPolicy.LOG)
    call(rows, 0)
    call(rows.limit(0), 1)
    assert handler.seen == [("insert", 18)] and handler.idle == 1 and handler.errors == ["no deletes here"]
    with pytest.raises(PublishError):
        dispatch(handler)(rows, 2)


def test_sql_functions(spark):
    from tideline.functions.sql import export_view, register

    spark.createDataFrame([(1, "a")], "id int, name string").createOrReplaceTempView("people")
    spark.createDataFrame([("x",)], "note string").createOrReplaceTempView("notes")
    tables = [Table(1, "people", ["id"]), Table(2, "notes")]
    register(spark, tables)
    row = spark.sql("SELECT tl_row_schema('people') r, tl_key_schema('people') k, tl_frame_schema() f").first()
    assert '"name":"people"' in row["r"] and '"name":"people_pkey"' in row["k"] and '"name":"Frame"' in row["f"]
    with pytest.raises(Exception, match="has no key"):
        spark.sql("SELECT tl_key_schema('notes')").collect()
    with pytest.raises(CatalogError):
        export_view(spark, tables)
    export_view(spark, tables, allow_unkeyed=True)
    got = spark.sql("SELECT key, value FROM tl_export WHERE table_name = 'people'").collect()
    assert [tuple(r) for r in got] == [('{"id":{"int":1}}', '{"id":{"int":1},"name":{"string":"a"}}')]
