"""Long logs: one start reads all batches, and a batch reads few rows besides its own."""

import pytest
from pyspark.sql import functions as F

from tideline.functions import avro
from tideline.operators.log import schema_in_force, version_in_force
from tideline.sources import changelog
from tideline.sources.catalog import Table
from tideline.sources.changelog import StreamReader, _Log
from tideline.streaming.publish import _json_texts
from tideline.streaming.replicate import Job, follow
from tideline.streaming.sinks import FolderSink

TYPED = "lsn long, seq int, xid long, kind string, key struct<id:long>, old_key struct<id:long>, new struct<id:long,name:string>"


def typed(spark, n):
    row = F.struct(F.col("id"), F.concat(F.lit("name "), "id").alias("name"))
    return spark.range(n).select(
        (F.col("id") + 1).alias("lsn"), F.lit(0).alias("seq"), F.expr("id div 10").alias("xid"), F.lit("insert").alias("kind"),
        F.struct("id").alias("key"), F.lit(None).cast("struct<id:long>").alias("old_key"), row.alias("new"),
    )


def test_a_batch_reads_the_row_groups_of_its_positions(spark, tmp_path):
    path = str(tmp_path / "log")
    changelog.write_log(typed(spark, 200_000).orderBy(F.xxhash64("lsn")), path, 64 << 10)
    log = _Log({"path": path, "maxTransactions": "600"}, spark.read.parquet(path).schema)
    reader = StreamReader(log)
    assert [reader.latestOffset()["lsn"] for _ in range(3)] == [6000, 12_000, 18_000]
    sizes = {(g.path, g.row_groups[0].id): n for _, _, n, g in log.pieces(-1)}
    parts = reader.partitions({"lsn": 12_000}, {"lsn": 18_000})
    opened = {(p, k) for part in parts for p, numbers in part.groups.items() for k in numbers}
    assert sum(sizes.values()) == 200_000 and sum(sizes[x] for x in opened) < 60_000
    got = sorted(x for part in parts for b in log.read(part) for x in b.column("lsn").to_pylist())
    assert got == list(range(12_001, 18_001))


def test_footers_are_read_again_when_files_change(spark, tmp_path):
    path = str(tmp_path / "log")
    typed(spark, 100).write.parquet(path)
    log = _Log({"path": path}, spark.read.parquet(path).schema)
    assert max(p[1] for p in log.pieces(-1)) == 100
    typed(spark, 150).write.mode("overwrite").parquet(path)
    assert max(p[1] for p in log.pieces(-1)) == 150 and sum(p[2] for p in log.pieces(-1)) == 150


@pytest.mark.parametrize("resumed", [False, True])
def test_one_start_reads_all_batches(spark, tmp_path, resumed):
    path, sink, starts = str(tmp_path / "log"), FolderSink(str(tmp_path / "topics")), []
    changelog.write_log(typed(spark, 95), path)
    changelog.register(spark)
    rows = spark.readStream.format("changelog").schema(TYPED).option("path", path).option("maxTransactions", 2).load()
    job = Job(sink, str(tmp_path / "c"), "json")
    if resumed:
        job.stream_table(rows, Table(7, "gadgets", ["id"])).awaitTermination()

    def start(trigger):
        starts.append(trigger)
        return job.stream_table(rows, Table(7, "gadgets", ["id"]), trigger=trigger)

    follow(start)
    got = spark.read.parquet(sink.path)
    assert len(starts) == 1 and sorted(r["lsn"] for r in got.collect()) == list(range(1, 96))
    assert sorted(r["count"] for r in got.groupBy("batch").count().collect()) == [15, 20, 20, 20, 20]


def test_few_versions_equal_the_join(spark):
    versions = [(1, 0, -1), (1, 5, -1), (1, 5, 2), (2, 3, -1), (None, 4, 0)]
    rows = spark.createDataFrame([(r, x, s) for r in (1, 2, 3, None) for x in range(8) for s in range(4)], "relid long, lsn long, seq int")
    marks = spark.createDataFrame([(*v, k) for k, v in enumerate(versions)], "relid long, lsn long, seq int, n int")
    want = {(r["relid"], r["lsn"], r["seq"]): r["n"] for r in schema_in_force(rows, marks, "n").collect()}
    assert {(r["relid"], r["lsn"], r["seq"]): r["n"] for r in rows.withColumn("n", version_in_force(versions)).collect()} == want


def test_json_texts_of_plain_values_equal_those_of_single_ones(spark):
    import json

    from tideline.functions.wire import row_schema
    from tideline.streaming.publish import _tagged

    columns = "a int, b long, c float, d double, e boolean, f string, g binary, h date"
    data = [
        (1, -(2**63), 0.1, 1e300, True, 'q"\\\n é', b"\x00\xff", None), (None,) * 8, (-5, 7, float("inf"), float("nan"), False, "", b"", None),
    ]
    df = spark.createDataFrame(data, columns)
    for part in (df.drop("h"), df):
        schema = row_schema("t", part.schema)
        records = avro.encode_table(part, "t", out="r", keep=[]).toArrow().column("r").combine_chunks()
        want = [json.dumps(_tagged(schema, avro.decode_whole(schema, v)), separators=(",", ":"), ensure_ascii=False) for v in records.to_pylist()]
        assert _json_texts(schema, records) == want


def test_a_small_batch_is_read_by_one_task(spark, tmp_path):
    path = str(tmp_path / "log")
    changelog.write_log(typed(spark, 200_000), path, 64 << 10)
    log = _Log({"path": path}, spark.read.parquet(path).schema)
    small, large = log.ranges(12_000, 18_000), log.ranges(-1, 200_000)
    assert [(r.low, r.high) for r in small] == [(12_000, 18_000)] and len(large) == 4
    assert sorted(x for b in log.read(small[0]) for x in b.column("lsn").to_pylist()) == list(range(12_001, 18_001))
    sizes = [sum(b.num_rows for b in log.read(part)) for part in large]
    assert sum(sizes) == 200_000 and max(sizes) < 70_000


@pytest.mark.parametrize("form", ["json", "avro"])
def test_a_small_batch_is_published_without_a_shuffle(spark, tmp_path, form):
    from tideline.plans.inputs import encoded_events

    spark.range(100).selectExpr("id AS event_id", "id % 7 AS user_id", "'t' AS event_type").write.parquet(str(tmp_path / "events.parquet"))
    path, sink, moved = str(tmp_path / "log"), FolderSink(str(tmp_path / "topics")), []
    events = encoded_events(spark, str(tmp_path), 51)
    changelog.write_log(events, path)
    changelog.register(spark)
    rows = spark.readStream.format("changelog").schema(events.schema).option("path", path).option("maxTransactions", 3).load()
    written = sink._write

    def write(messages, batch_id):
        moved.append("Exchange" in messages._jdf.queryExecution().executedPlan().toString())
        written(messages, batch_id)

    sink._write = write
    job = Job(sink, str(tmp_path / "c"), form)
    follow(lambda trigger: job.stream_events(rows, trigger=trigger))
    got = spark.read.parquet(sink.path).orderBy("lsn").collect()
    assert len(moved) >= 3 and not any(moved)
    assert [r["lsn"] for r in got] == list(range(1, 101))
    assert [r["topic"] for r in got] == ["events"] * 51 + ["happenings"] * 49
    assert [r["lsn"] for r in got if r["value"] is None] == list(range(10, 101, 10))


def test_a_query_with_a_local_checkpoint_leaves_the_session_as_it_was(spark, tmp_path):
    from tideline.streaming.replicate import CHECKPOINT_FILES, _plain_renames

    with _plain_renames(spark, str(tmp_path)):
        assert spark.conf.get(CHECKPOINT_FILES).endswith("FileSystemBasedCheckpointFileManager")
    assert spark.conf.get(CHECKPOINT_FILES, None) is None
    spark.conf.set(CHECKPOINT_FILES, "x")
    try:
        with _plain_renames(spark, str(tmp_path)):
            assert spark.conf.get(CHECKPOINT_FILES) == "x"
    finally:
        spark.conf.unset(CHECKPOINT_FILES)


def test_json_arrays_escape_what_a_string_needs():
    import json

    import pyarrow as pa

    from tideline.streaming.publish import _plain_texts

    for text in ("a\nb", 'q"', "\\", "\x00", "\x1f", "é\x7f", "", "plain"):
        want = [json.dumps(text, ensure_ascii=False), '"p"', None]
        assert _plain_texts("string", pa.array([text, "p", None])).to_pylist() == want


def test_a_log_is_made_once_to_be_written(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def stage(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    log = spark.range(1000).selectExpr("id AS lsn", "id div 10 AS xid").mapInArrow(stage, "lsn long, xid long")
    changelog.write_log(log, str(tmp_path / "log"))
    assert made.value == 1000 and not log.storageLevel.useDisk
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1000
    log.persist()
    changelog.write_log(log, str(tmp_path / "again"))
    assert log.storageLevel.useMemory
    log.unpersist()
