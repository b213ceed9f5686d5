"""Change-log operators on small literal logs."""

import pytest
from pyspark.sql import functions as F

from tideline.functions import avro, temporal
from tideline.operators import compact, log, messages, transactions
from tideline.plans.inputs import catalog
from tideline.sources import catalog as cat
from tideline.sources.catalog import Table
from tideline.sources.snapshot import export, hand_over, snapshot_log

LOG = "lsn long, seq int, xid long, kind string, key string, old_key string, new string"


def make(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_upserts_tombstones_and_unkeyed(spark):
    rows = [(1, 0, 1, "begin", None, None, None), (2, 0, 1, "insert", "a", None, "1"), (3, 0, 1, "update", "a", None, "2"), (4, 0, 1, "delete", "a", None, None), (5, 0, 1, "delete", None, None, None), (6, 0, 1, "insert", None, None, "9")]
    got = messages.to_messages(make(spark, rows), F.col("key"), F.col("new"), F.lit("t"), 2).orderBy("lsn").collect()
    assert [(r["key"], r["value"]) for r in got] == [("a", "1"), ("a", "2"), ("a", None), (None, "9")]
    assert len({r["partition"] for r in got if r["key"] == "a"}) == 1


def test_key_change_splits_in_order(spark):
    rows = [(1, 0, 1, "update", "b", "a", "x"), (2, 0, 1, "update", "b", "b", "y"), (3, 0, 1, "update", "c", None, "z"), (4, 1, 1, "insert", "d", None, "w")]
    out = log.split_key_changes(make(spark, rows), F.col("old_key")).orderBy("lsn", "seq").collect()
    assert [(r["lsn"], r["seq"], r["kind"], r["key"], r["new"]) for r in out] == [
        (1, 0, "delete", "a", None), (1, 1, "insert", "b", "x"), (2, 0, "update", "b", "y"), (3, 0, "update", "c", "z"), (4, 2, "insert", "d", "w"),
    ]


def test_compaction(spark):
    rows = [(1, 0, 1, "insert", "a", None, "1"), (1, 1, 1, "update", "a", None, "2"), (2, 0, 1, "insert", "b", None, "3"), (3, 0, 1, "delete", "b", None, None), (4, 0, 1, "insert", "c", None, None)]
    out = compact.latest(make(spark, rows), ["key"], log.position(), F.col("kind") == "delete", ["new"])
    assert sorted(map(tuple, out.collect())) == [("a", "2"), ("c", None)]


def test_schema_as_of_and_changes(spark):
    rows = spark.createDataFrame([(1, n, 0) for n in (1, 5, 6, 9)] + [(2, 5, 0)], "relid long, lsn long, seq int")
    events = spark.createDataFrame([(1, 5, -1, "v1"), (1, 7, 0, "v2"), (1, 8, 0, "v2")], "relid long, lsn long, seq int, schema_version string")
    few = {(r["relid"], r["lsn"]): r["schema_version"] for r in log.schema_in_force(rows, events).collect()}
    got = {(r["relid"], r["lsn"]): r["schema_version"] for r in log.schema_in_force(rows, events, max_broadcast=2).collect()}
    assert got == few == {(1, 1): None, (1, 5): "v1", (1, 6): "v1", (1, 9): "v2", (2, 5): None}
    assert [r["change"] for r in log.schema_changes(events).orderBy("lsn").collect()] == ["new", "changed", "unchanged"]


def test_row_faults(spark):
    rows = make(spark, [(1, 0, 1, "insert", "a", None, None), (2, 0, 1, "delete", "a", None, None), (3, 0, 1, "merge", "a", None, "x")])
    got = [r[0] for r in rows.orderBy("lsn").select(log.check_rows(rows)).collect()]
    assert got == ["insert without a new row", None, "unknown change kind merge"]


def test_frames_explode(spark):
    frames = [
        (1, avro.encode_frame([(0, {"xid": 3}), (3, {"relid": 9, "key": b"k", "newRow": b"r"}), (1, {"xid": 3, "lsn": 1})])),
        (2, avro.encode_frame([])),
    ]
    out = log.explode_frames(spark.createDataFrame(frames, "lsn long, frame binary")).orderBy("frame_lsn", "seq").collect()
    assert [(r["frame_lsn"], r["seq"], r["kind"], r["xid"], r["relid"]) for r in out] == [(1, 0, "begin", 3, None), (1, 1, "insert", None, 9), (1, 2, "commit", 3, None)]
    bad = spark.createDataFrame([(1, frames[0][1] + b"\x00")], "lsn long, frame binary")
    with pytest.raises(Exception, match="bytes after the frame"):
        log.explode_frames(bad).collect()


def test_transactions(spark):
    rows = [(n, 0, n // 3 + 1, k, "a", None, "x") for n, k in enumerate(["begin", "insert", "commit", "begin", "insert", "commit", "begin", "insert", "commit"])]
    logged = make(spark, rows)
    txns = transactions.summary(logged, F.col("lsn") != 4)
    assert [tuple(r) for r in txns.orderBy("xid").select("xid", "events", "pending", "commit_lsn").collect()] == [(1, 1, 0, 2), (2, 1, 1, 5), (3, 1, 0, 8)]
    assert transactions.checkpoint(txns).first()[0] == 2
    assert [r["in_flight"] for r in transactions.in_flight(txns).orderBy("xid").collect()] == [1, 1, 2]
    assert transactions.over_limit(transactions.in_flight(txns), 1).count() == 1
    done = transactions.summary(logged, F.lit(True))
    assert transactions.checkpoint(done).first()[0] == 8
    assert transactions.checkpoint(done.limit(0)).first()[0] is None
    assert transactions.brackets(logged).count() == 0
    broken = make(spark, rows[:2] + rows[3:4] + rows[3:6])
    assert {r["xid"]: r["fault"] for r in transactions.brackets(broken).collect()} == {1: "no commit", 2: "2 begin events"}


def test_running_total(spark):
    d = spark.range(1000).withColumn("v", F.col("id") % 7)
    for buckets in (1, 13, 5000):
        got = {r["id"]: r["t"] for r in transactions.running_total(d, "id", F.col("v"), "t", buckets).collect()}
        total = 0
        for i in range(1000):
            total += i % 7
            assert got[i] == total
    assert transactions.running_total(d.limit(0), "id", F.col("v"), "t").count() == 0


def test_catalog(spark):
    tables = cat.discover(*catalog(spark))
    found = {r["table_name"]: r["key_index"] for r in tables.collect()}
    assert found == {"users": "users_pkey", "accounts": "accounts_pkey", "orders": "orders_alt", "logs": None, "notes": None, "sales": "sales_pkey", "half_index": None, "broken": None}
    assert {r["table_name"] for r in cat.discover(*catalog(spark), "%a%s").collect()} == {"accounts", "sales"}
    with pytest.raises(cat.CatalogError, match="public.logs .replica identity is NOTHING"):
        cat.check(tables)
    cat.check(tables, allow_unkeyed=True)
    with pytest.raises(cat.CatalogError, match="more than one"):
        cat.check(tables.unionAll(tables.filter("relid = 100")), True)
    c, _, i = catalog(spark)
    stream = {r["relid"]: r["key_index_id"] for r in cat.key_for_stream(c, i).collect()}
    assert (stream[100], stream[102], stream[103], stream[110], stream[112]) == (200, 202, None, 206, None)


def test_snapshots(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b")], "id int, username string")
    logged = snapshot_log(users, Table(5, "users", ["id"]))
    assert {(r["lsn"], r["kind"], r["key"]["id"], r["new"]["username"]) for r in logged.collect()} == {(0, "insert", 1, "a"), (0, "insert", 2, "b")}
    with pytest.raises(cat.CatalogError):
        export(lambda n: users, [Table(1, "t")])
    for form in ("json", "avro"):
        out = export(lambda n: users, [Table(1, "t"), Table(2, "u", ["id"])], form, allow_unkeyed=True)
        assert out.count() == 4 and out.filter("key is null").count() == 2
    with pytest.raises(ValueError):
        export(lambda n: users, [Table(1, "t", ["id"])], "xml")
    stream = spark.createDataFrame([(k,) for k in (3, 4, 5)], "lsn long")
    assert sorted(r["lsn"] for r in hand_over(logged.select("lsn"), stream, 3).collect()) == [0, 0, 4, 5]


def test_intervals(spark):
    p = temporal.interval_parts(F.lit(-14), F.lit(3), F.lit(-5025123456))
    assert tuple(spark.range(1).select(p.alias("p")).first()["p"]) == (-1, -2, 3, -1, -23, -45, -123456)
    z = spark.sql("SELECT timestamp'2014-07-01 12:00:00' AS t").select(temporal.zone_offset(F.col("t"), "Europe/Berlin").alias("z")).first()
    assert z["z"] == 7200
    tz = spark.range(1).select(temporal.time_tz(F.lit(5), F.lit(3600)).alias("t")).first()["t"]
    assert tuple(tz) == (5, 3600)
