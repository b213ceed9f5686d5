"""Every registered core query against its SQL in DuckDB, at the smallest scale."""

import glob
import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from tideline.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        files = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{files}')")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    return Counter(tuple(str(x) if x is not None and x == x else None for x in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_partition_numbers(spark):
    """Against zlib: SQL has no CRC-32."""
    import zlib

    users = duckdb.sql(f"SELECT user_id, count(*) FROM read_parquet('{SF}/events.parquet') GROUP BY 1").fetchall()
    want, keys = Counter(), Counter()
    for user, n in users:
        p = zlib.crc32(str(user).encode()) % 8
        want[p] += n
        keys[p] += 1
    got = QUERIES["partition_numbers"](spark, SF).collect()
    assert {r["partition"]: (r["n"], r["keys"]) for r in got} == {p: (want[p], keys[p]) for p in want}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_core_does_not_import_the_optional_part():
    for path in glob.glob(os.path.join(os.path.dirname(__spark_entry__.__file__), "tideline", "**", "*.py"), recursive=True):
        if f"{os.sep}llm{os.sep}" not in path:
            with open(path, encoding="utf-8") as f:
                text = f.read()
            assert not re.search(r"\bllm\b|corpus_pipeline", text), path
