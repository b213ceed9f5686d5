"""Logs published by the replication job: order, tombstones, schema changes, renames, dead letters, handover."""

import json

import pytest
from pyspark.sql import functions as F

from tideline.functions import avro
from tideline.functions.wire import key_schema, row_schema, schema_json
from tideline.operators import log, messages
from tideline.policy import ErrorPolicy, PublishError
from tideline.registry import MemoryRegistry, RegistryError
from tideline.sources.catalog import Table
from tideline.sources.changelog import StreamReader, _Log, log_end, register
from tideline.sources.snapshot import snapshot_log
from tideline.streaming.handlers import Handler, Keepalive
from tideline.streaming.publish import EventPublisher, topic_of
from tideline.streaming.replicate import Job, drain, run
from tideline.streaming.sinks import ConsoleSink, FolderSink

TYPED = "lsn long, seq int, xid long, kind string, key struct<id:int>, old_key struct<id:int>, new struct<id:int,name:string>"
EVENTS = "lsn long, seq int, xid long, kind string, relid long, key binary, new_row binary, key_schema string, row_schema string"


def stream_of(spark, path, schema, **options):
    register(spark)
    return spark.readStream.format("changelog").schema(schema).option("path", path).options(**options).load()


def append(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("form", ["json", "avro"])
def test_typed_log(spark, tmp_path, form):
    """Inserts and updates are upserts, deletes tombstones, a changed key is a tombstone and an upsert."""
    rows = [
        (1, 0, 1, "insert", (1,), None, (1, "Hello")), (2, 0, 2, "update", (1,), None, (1, "Goodbye")), (3, 0, 3, "insert", (2,), None, (2, None)),
        (4, 0, 4, "update", (3,), (2,), (3, "moved")), (5, 0, 5, "delete", (1,), None, None),
    ]
    path = str(tmp_path / "log")
    append(spark, path, rows, TYPED)
    sink = FolderSink(str(tmp_path / "topics"))
    job = Job(sink, str(tmp_path / "c"), form, MemoryRegistry() if form == "avro" else None)
    assert drain(lambda: job.stream_table(stream_of(spark, path, TYPED, maxTransactions=2), Table(7, "gadgets", ["id"]))) == 3
    got = sink.read(spark).orderBy("lsn", "seq").collect()
    assert {r["topic"] for r in got} == {"gadgets"}
    if form == "json":
        seen = [(json.loads(r["key"])["id"]["int"], r["value"] and json.loads(r["value"])["name"]) for r in got]
        assert seen == [(1, {"string": "Hello"}), (1, {"string": "Goodbye"}), (2, None), (2, None), (3, {"string": "moved"}), (1, None)]
        assert got[2]["value"] is not None and got[3]["value"] is None
    else:
        assert [bytes(r["key"]).hex() for r in got] == [f"0000000001{x}" for x in ("0202", "0202", "0204", "0204", "0206", "0202")]
        assert bytes(got[0]["value"]).hex() == "0000000002" + "0202" + "020a" + b"Hello".hex() and got[5]["value"] is None


def test_faulty_rows_follow_the_policy(spark, tmp_path):
    path = str(tmp_path / "log")
    append(spark, path, [(1, 0, 1, "insert", (1,), None, (1, "a")), (2, 0, 1, "insert", (2,), None, None)], TYPED)
    for policy in ErrorPolicy:
        sink = FolderSink(str(tmp_path / f"to-{policy.value}"))
        job = Job(sink, str(tmp_path / f"c{policy.value}"), "json", policy=policy)
        query = job.stream_table(stream_of(spark, path, TYPED), Table(7, "t", ["id"]))
        if policy is ErrorPolicy.EXIT:
            with pytest.raises(Exception, match="insert without a new row"):
                query.awaitTermination()
        else:
            query.awaitTermination()
            assert [r["lsn"] for r in sink.read(spark).collect()] == [1]


def test_repeated_unkeyed_rows_survive(spark, tmp_path):
    notes = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "note string").repartition(3)
    sink = FolderSink(str(tmp_path / "topics"))
    job = Job(sink, str(tmp_path / "c"), "json", allow_unkeyed=True)
    for _ in range(2):  # a repeated snapshot replaces the first
        job.snapshot(lambda n: notes, [Table(1, "notes")])
        assert sink.read(spark).count() == 7
    logged = snapshot_log(spark.range(100).selectExpr("'same' AS event"), Table(1, "events"))
    assert messages.deduplicate(messages.to_messages(logged, F.lit(None).cast("string"), F.col("new"), F.lit("t"))).count() == 100
    spread = messages.to_messages(logged, F.lit(None).cast("string"), F.col("new"), F.lit("t"), 2).groupBy("partition").count().collect()
    assert len(spread) == 2 and all(30 <= r["count"] <= 70 for r in spread)


def test_failed_snapshot_takes_back_what_it_published(spark, tmp_path):
    sink = FolderSink(str(tmp_path / "topics"))
    job = Job(sink, str(tmp_path / "c"), "json")
    read = lambda n: spark.range(3).selectExpr("id") if n == "good" else spark.read.parquet(str(tmp_path / "missing"))
    with pytest.raises(PublishError):
        run(spark, job, read, [Table(1, "good", ["id"]), Table(2, "gone", ["id"])])
    assert not list((tmp_path / "topics").glob("**/*.parquet")) and not job.has_checkpoint(spark)


# ---------------------------------------------------------------- schema changes in mid-stream


def encoded(table, fields, **row):
    """(key schema, row schema, encode) of a table version."""
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(fields)
    keyed = "id" in schema.names
    rows = row_schema(table, schema)
    keys = key_schema(f"{table}_pkey", schema, ["id"]) if keyed else None

    def make(**values):
        return (avro.encode(keys, {"id": values["id"]}) if keyed else None), avro.encode(rows, values)

    return schema_json(keys) if keyed else None, schema_json(rows), make


def announce(lsn, relid, version):
    return (lsn, 0, lsn, "schema", relid, None, None, version[0], version[1])


def change(lsn, kind, relid, version, **values):
    key, row = version[2](**values)
    return (lsn, 0, lsn, kind, relid, key, None if kind == "delete" else row, None, None)


@pytest.mark.parametrize("form", ["json", "avro"])
def test_rename_new_column_and_new_key(spark, tmp_path, form):
    """A renamed table goes on under its new topic; a new column and a new key are in messages from then on; all over a restart."""
    users, members = encoded("users", "id int, age int"), encoded("members", "id int, age int")
    old, new = encoded("customers", "age int"), encoded("customers", "age int, name string")
    bare, keyed = encoded("products", "sku int"), encoded("products", "id int, sku int")
    first = [
        announce(1, 1, users), change(2, "insert", 1, users, id=1, age=31), announce(3, 2, old), change(4, "insert", 2, old, age=31),
        announce(5, 3, bare), change(6, "insert", 3, bare, sku=31), change(7, "delete", 3, bare, sku=31),
    ]
    second = [
        change(10, "insert", 1, users, id=2, age=7), announce(11, 1, members), change(12, "insert", 1, members, id=3, age=42),
        announce(13, 2, new), change(14, "insert", 2, new, age=42, name="n"), announce(15, 3, keyed), change(16, "insert", 3, keyed, id=1, sku=42),
        change(17, "delete", 3, keyed, id=1, sku=42),
    ]
    path, sink = str(tmp_path / "log"), FolderSink(str(tmp_path / "topics"))
    registry = MemoryRegistry() if form == "avro" else None
    for rows in (first, second):
        append(spark, path, rows, EVENTS)
        job = Job(sink, str(tmp_path / "c"), form, registry, "p")  # a new job each time: what it knows comes from the checkpoint
        drain(lambda: job.stream_events(stream_of(spark, path, EVENTS, maxTransactions=3)))  # noqa: B023
    got = {r["lsn"]: (r["topic"], r["key"], r["value"]) for r in sink.read(spark).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        2: "p.users", 4: "p.customers", 6: "p.products", 10: "p.users", 12: "p.members", 14: "p.customers", 16: "p.products", 17: "p.products"
    }
    assert got[17][2] is None and got[6][1] is None and got[16][1] is not None
    if form == "json":
        assert json.loads(got[14][2]) == {"age": {"int": 42}, "name": {"string": "n"}} and json.loads(got[4][2]) == {"age": {"int": 31}}
        assert json.loads(got[12][1]) == {"id": {"int": 3}} and json.loads(got[16][2]) == {"id": {"int": 1}, "sku": {"int": 42}}
    else:
        number = lambda lsn: int.from_bytes(bytes(got[lsn][2])[1:5], "big")
        assert number(2) == number(10) and number(4) != number(14) and number(6) != number(16)
        assert set(registry.subjects) == {"p.users-key", "p.users-value", "p.members-key", "p.members-value", "p.customers-value", "p.products-key", "p.products-value"}
        assert avro.decode_whole(json.loads(new[1]), bytes(got[14][2])[5:]) == {"age": 42, "name": "n"}


class Refusing(MemoryRegistry):
    def register(self, subject, schema):
        if "bad" in subject:
            raise RegistryError("no such subject")
        return super().register(subject, schema)


def test_dead_letters(spark, tmp_path):
    """Rows of unnamed tables and of tables whose registration failed are set aside until the table is announced again."""
    bad, good = encoded("bad", "id int"), encoded("good", "id int")
    rows = [
        announce(1, 1, bad), change(2, "insert", 1, bad, id=1), change(3, "insert", 9, good, id=1), announce(4, 1, good), change(5, "insert", 1, good, id=2),
        (6, 0, 6, "insert", None, b"", b"", None, None),
    ]
    events = spark.createDataFrame(rows, EVENTS)
    publisher = EventPublisher(str(tmp_path / "state"), "avro", Refusing(), None, ErrorPolicy.LOG)
    sent, dead = publisher.messages(events, 0)
    assert [r["lsn"] for r in sent.collect()] == [5]
    assert {r["lsn"]: r["error"] for r in dead.collect()} == {2: "no such subject", 3: "unknown table 9", 6: "unknown table null"}
    again = EventPublisher(str(tmp_path / "state"), "avro", Refusing(), None, ErrorPolicy.LOG)
    later, _ = again.messages(spark.createDataFrame([change(8, "insert", 1, good, id=5)], EVENTS), 1)
    assert [r["topic"] for r in later.collect()] == ["good"]
    with pytest.raises(PublishError):
        EventPublisher(str(tmp_path / "other"), "avro", Refusing()).messages(events, 0)


def test_topics_of_schemas():
    from pyspark.sql import types as T

    plain = schema_json(row_schema("a b", T.StructType.fromDDL("id int")))
    other = schema_json(row_schema("t", T.StructType.fromDDL("id int"), "my.shop"))
    assert (topic_of(plain), topic_of(plain, "p"), topic_of(other)) == ("a_20_b", "p.a_20_b", "my_2e_shop.t")


def test_bad_frames_are_rows_if_asked(spark):
    good = avro.encode_frame([(3, {"relid": 9, "key": None, "newRow": b"r"})])
    frames = spark.createDataFrame([(1, good), (2, good + b"x"), (3, b"\x02"), (4, None)], "lsn long, frame binary")
    got = {r["frame_lsn"]: (r["kind"], r["fault"]) for r in log.explode_frames(frames, faults=True).collect()}
    assert got[1] == ("insert", None) and got[2][0] is None and "after the frame" in got[2][1] and got[3][0] is None and 4 not in got
    with pytest.raises(Exception, match="after the frame"):
        log.explode_frames(frames).collect()


# ---------------------------------------------------------------- positions


BRACKETED = "lsn long, seq int, xid long, kind string, key string, value string"


def test_batches_end_at_commits(spark, tmp_path):
    """A half-written transaction is not read; batches are cut at commits whatever the row groups."""
    path = str(tmp_path / "log")
    rows = []
    for x in range(1, 8):
        rows += [(10 * x, 0, x, "begin", None, None), *[(10 * x + k, 0, x, "insert", "k", "v") for k in range(1, 5)], (10 * x + 5, 0, x, "commit", None, None)]
    for part in (rows[:9], rows[9:30], rows[30:], [(90, 0, 9, "begin", None, None), (91, 0, 9, "insert", "k", "v")]):
        append(spark, path, part, BRACKETED)
    schema = spark.read.parquet(path).schema
    reader = StreamReader(_Log({"path": path, "maxTransactions": "3"}, schema))
    assert [reader.latestOffset()["lsn"] for _ in range(4)] == [35, 65, 75, 75]
    assert log_end(path) == 75 and _Log({"path": path}, schema).ends(35) == [(10 * x + 5, x) for x in range(4, 8)]
    register(spark)
    assert spark.read.format("changelog").schema(BRACKETED).option("path", path).load().agg(F.max("lsn"), F.count("*")).first() == (75, 42)
    for parts in ("1", "2", "5", "50"):
        ranges = _Log({"path": path, "partitions": parts}, schema).ranges(-1, 75)
        assert ranges[0].low == -1 and ranges[-1].high == 75 and all(a.high == b.low for a, b in zip(ranges, ranges[1:])) and len(ranges) <= int(parts)
    only = spark.createDataFrame(rows[:1], BRACKETED)
    only.write.parquet(str(tmp_path / "begun"))
    assert log_end(str(tmp_path / "begun")) == -1


def test_handover_and_restart(spark, tmp_path):
    """The stream starts after the position that the log had before the snapshot, also when started again."""
    path, sink = str(tmp_path / "log"), FolderSink(str(tmp_path / "topics"))
    users = spark.createDataFrame([(1, "user1"), (2, "user2")], "id int, name string")
    version = encoded("users", "id int, name string")
    append(spark, path, [announce(1, 1, version), change(2, "insert", 1, version, id=1, name="user1"), change(3, "insert", 1, version, id=2, name="user2")], EVENTS)
    job = Job(sink, str(tmp_path / "c"), "json")

    def go():
        return run(spark, job, lambda n: users, [Table(1, "users", ["id"])], events=stream_of(spark, path, EVENTS), log_end=lambda: log_end(path))

    drain(go)
    assert sorted(r["lsn"] for r in sink.read(spark).collect()) == [0, 0] and job.position(spark) == 3
    append(spark, path, [change(4, "insert", 1, version, id=3, name="user3")], EVENTS)
    drain(go)
    got = sink.read(spark).collect()
    assert sorted(r["lsn"] for r in got) == [0, 0, 4] and json.loads(next(r["value"] for r in got if r["lsn"] == 4))["name"] == {"string": "user3"}


def test_keepalive_and_console(spark, capsys):
    class Idle(Handler):
        calls = 0

        def on_keepalive(self, batch_id):
            self.calls += 1

    handler = Idle()
    Keepalive(handler).onQueryIdle(None)
    assert handler.calls == 1
    rows = spark.createDataFrame([(2, 1, 5, "t", "k", None), (1, 0, 5, "t", None, "v")], "lsn long, seq long, xid long, topic string, key string, value string")
    ConsoleSink(1).write(rows, 0)
    assert capsys.readouterr().out == "xid=5 lsn=1 t key=null value=v\n"


def test_command_line_follows_a_log(spark, tmp_path, capsys):
    from tideline.cli import main, make_sink, parse

    assert main(["--config-help"]) == 0 and "-T K=V" in capsys.readouterr().out
    assert parse(["-d", "x", "--start-lsn", "1/FF"]).start_lsn == 4294967551
    assert make_sink("kafka:h:1", {"a": "1", "b": "2"}, {"a": "3"}).options == {"a": "3", "b": "2"}
    assert make_sink("folder:/x", {"compression": "gzip"}, {"by_key": "false"}).by_key is False
    spark.createDataFrame([(1, "a")], "id int, name string").write.parquet(str(tmp_path / "src" / "users.parquet"))
    cat = {
        "class": ([(5, 1, "users", "r", "d", "p"), (6, 1, "users_pkey", "i", "n", "p"), (7, 2, "hidden", "r", "d", "p")], "oid long, relnamespace long, relname string, relkind string, relreplident string, relpersistence string"),
        "namespace": ([(1, "public"), (2, "pg_catalog")], "oid long, nspname string"),
        "index": ([(6, 5, True, False, True, True, ["id"])], "indexrelid long, indrelid long, indisprimary boolean, indisreplident boolean, indisvalid boolean, indisready boolean, columns array<string>"),
    }
    for name, (rows, schema) in cat.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "cat" / f"{name}.parquet"))
    version = encoded("users", "id int, name string")
    path = str(tmp_path / "log")
    append(spark, path, [announce(1, 5, version)], EVENTS)
    args = ["-d", str(tmp_path / "src"), "-l", path, "-b", f"folder:{tmp_path}/topics", "-f", "json", "--checkpoint-dir", str(tmp_path / "c"), "--catalog", str(tmp_path / "cat"), "--until-end"]
    assert main(args) == 0
    append(spark, path, [change(2, "insert", 5, version, id=2, name="b")], EVENTS)
    assert main(args) == 0
    got = FolderSink(f"{tmp_path}/topics").read(spark).collect()
    assert sorted((r["lsn"], json.loads(r["key"])["id"]["int"]) for r in got) == [(0, 1), (2, 2)]


def test_export_as_a_table_function(spark):
    from tideline.functions.sql import export_function

    spark.createDataFrame([(1, "a")], "id int, name string").createOrReplaceTempView("people2")
    spark.createDataFrame([("x",)], "note string").createOrReplaceTempView("notes2")
    tables = [Table(1, "people2", ["id"]), Table(2, "notes2")]
    export_function(spark, tables)
    count = lambda sql: spark.sql(sql).count()
    assert count("SELECT * FROM tl_export_like('people%', false)") == 1 and count("SELECT * FROM tl_export_like('%', true)") == 2
    with pytest.raises(Exception, match="without a key"):
        spark.sql("SELECT * FROM tl_export_like('%', false)").collect()
    export_function(spark, tables, policy=ErrorPolicy.LOG)
    assert count("SELECT * FROM tl_export_like('%', false)") == 1


def test_keys_compare_as_their_bytes(spark):
    schema = "lsn long, seq int, xid long, kind string, key struct<k:double>, old_key struct<k:double>, new struct<k:double>"
    nan = float("nan")
    rows = [(1, 0, 1, "update", (0.0,), (-0.0,), (0.0,)), (2, 0, 1, "update", (nan,), (nan,), (nan,)), (3, 0, 1, "update", (None,), (None,), (None,)), (4, 0, 1, "update", (None,), (1.0,), (None,))]
    out = log.split_key_changes(spark.createDataFrame(rows, schema), F.col("old_key")).groupBy("lsn").count().orderBy("lsn").collect()
    assert [tuple(r) for r in out] == [(1, 2), (2, 1), (3, 1), (4, 2)]


def test_null_relations_have_no_schema(spark):
    rows = spark.createDataFrame([(None, 5, 0), (1, 5, 0)], "relid long, lsn long, seq int")
    marks = spark.createDataFrame([(None, 1, 0, "a"), (1, 1, 0, "b")], "relid long, lsn long, seq int, schema_version string")
    for most in (1000, 0):
        got = {r["relid"]: r["schema_version"] for r in log.schema_in_force(rows, marks, max_broadcast=most).collect()}
        assert got == {None: None, 1: "b"}
