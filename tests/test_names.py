"""Names, positions, options and policies on plain values and on columns."""

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.functions import naming
from tideline.plans.inputs import LSNS, NAMES
from tideline.policy import ErrorPolicy, PublishError, apply_policy, dead_letters, handle, row_fault


def test_sanitise():
    assert naming.sanitise("users") == "users"
    assert naming.sanitise("crêpes") == "cr_c3__aa_pes"
    assert naming.sanitise("9lives") == "_39_lives"
    assert naming.sanitise("a.b") == "a_2e_b"
    assert naming.sanitise("a.b", namespace=True) == "a.b"
    assert naming.sanitise(".a.", namespace=True) == "_2e_a_2e_"
    assert naming.sanitise("person/name") == "person_2f_name"
    assert naming.sanitise("z" * 63) == "z" * 63
    assert naming.sanitise("") == ""


@given(st.text(max_size=30))
def test_sanitised_names_are_names(name):
    assert re.fullmatch("([A-Za-z_][A-Za-z0-9_]*)?", naming.sanitise(name))


def test_columns_agree_with_plain_functions(spark):
    d = spark.createDataFrame([(n,) for n in NAMES + ("", ".x.", "a.b.c")], "n string")
    rows = d.select("n", naming.sanitise_column(F.col("n")).alias("s"), naming.sanitise_column(F.col("n"), True).alias("ns")).collect()
    for r in rows:
        assert (r["s"], r["ns"]) == (naming.sanitise(r["n"]), naming.sanitise(r["n"], True))
    d = spark.createDataFrame([(x,) for x in [t for t, _ in LSNS]], "t string").withColumn("v", naming.parse_lsn_column(F.col("t")))
    for r in d.withColumn("again", naming.format_lsn_column(F.col("v"))).collect():
        assert r["v"] % 2**64 == naming.parse_lsn(r["t"]) and r["again"] == r["t"] == naming.format_lsn(r["v"])


def test_topics():
    assert naming.topic_name("users") == "users"
    assert naming.topic_name("things", "myapp") == "myapp.things"
    assert naming.topic_name("things", "public", "pre") == "pre.things"
    assert naming.topic_name("things", "myapp", "pre") == "pre.myapp.things"
    assert len(naming.topic_name("z" * 256)) == 256
    with pytest.raises(naming.TopicNameTooLong):
        naming.topic_name("z" * 257)
    assert naming.subject_name("t", "key") == "t-key"
    with pytest.raises(ValueError):
        naming.subject_name("t", "row")


def test_long_topic_column_fails(spark):
    d = spark.createDataFrame([("z" * 256,)], "t string")
    assert d.select(naming.checked_topic(naming.topic_column(F.col("t")))).count() == 1
    with pytest.raises(Exception, match="topic name too long"):
        d.select(naming.checked_topic(naming.topic_column(F.col("t"), None, "p"))).collect()


def test_small_things(spark):
    assert naming.split_option("a=b=c") == ("a", "b=c")
    for bad in ("a", "=b"):
        with pytest.raises(ValueError):
            naming.split_option(bad)
    assert naming.quote_identifier("n", 'a"b') == '"n"."a""b"'
    for bad in ("1", "x/1", "1/x", "123456789/0"):
        with pytest.raises(ValueError):
            naming.parse_lsn(bad)
    row = spark.range(1).select(F.hex(naming.big_endian(F.lit(258))).alias("l"), F.hex(naming.big_endian(F.lit(-1), 4)).alias("i")).first()
    assert tuple(row) == ("0000000000000102", "FFFFFFFF")


def test_partitions(spark):
    d = spark.range(1, 101).withColumn("k", F.col("id").cast("string"))
    n = d.select(naming.partition_column(F.col("k"), 2, [F.col("id")]).alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in n) == 100 and all(abs(r["count"] - 50) <= 10 for r in n)
    n = d.select(naming.partition_column(F.lit(None).cast("string"), 2, [F.col("id")]).alias("p")).groupBy("p").count().collect()
    assert len(n) == 2 and all(abs(r["count"] - 50) <= 20 for r in n)


def test_policy(spark, caplog):
    assert ErrorPolicy.parse("log") is ErrorPolicy.LOG and ErrorPolicy.parse("exit") is ErrorPolicy.EXIT
    with pytest.raises(ValueError):
        ErrorPolicy.parse("ignore")
    rows = spark.createDataFrame([(1, "ok"), (2, "x" * 2_000_000), (3, "ok"), (4, None)], "id int, value string")
    fine, bad = apply_policy(rows, row_fault(F.col("value")), ErrorPolicy.LOG)
    assert sorted(r["id"] for r in fine.collect()) == [1, 3, 4] and [r["id"] for r in bad.collect()] == [2]
    stop, none = apply_policy(rows, row_fault(F.col("value")), ErrorPolicy.EXIT)
    assert none.count() == 0
    with pytest.raises(Exception, match="row of 2000000 bytes"):
        stop.select("id").collect()
    lost = dead_letters(spark.createDataFrame([(1,), (2,), (None,)], "relid long"), spark.createDataFrame([(1,)], "relid long"))
    assert sorted(str(r[0]) for r in lost.collect()) == ["2", "None"]
    handle(ValueError("x"), ErrorPolicy.LOG, "table t")
    assert "table t: x" in caplog.text
    with pytest.raises(PublishError):
        handle(ValueError("x"), ErrorPolicy.EXIT, "table t")
