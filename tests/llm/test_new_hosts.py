"""Hosts without labelled pages are judged by the levels above them."""

from tideline.llm import url_filter


def test_new_hosts(spark):
    bad = [f"http://h{k}.bad.com/{i}" for k in range(6) for i in range(20)]
    good = [f"http://h{k}.good.org/{i}" for k in range(6) for i in range(20)]
    new = ["http://new.bad.com/", "http://new.good.org/", "http://a.other.org/", "no host"]
    pages = spark.createDataFrame(list(enumerate(bad + good + new)), "page_id long, url string")
    outcomes = spark.createDataFrame([(k, int(k < 120)) for k in range(240)], "page_id long, bad int")
    got = url_filter.judge(pages, outcomes).filter("page_id >= 240").orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block", "allow", "allow", "allow"]
    assert [r["labelled_pages"] for r in got] == [0, 0, 0, None]
    assert got[0]["posterior_mean"] > 0.9 and got[1]["posterior_mean"] < 0.1 and got[2]["posterior_mean"] < 0.5
    none = url_filter.judge(pages, outcomes.limit(0)).filter("verdict <> 'allow'")
    assert none.count() == 0


def test_new_hosts_agree_with_sql(spark, tmp_path):
    """Hosts without labels, below bad and good domains and suffixes, get the verdicts that the registered SQL gives."""
    import duckdb
    import numpy as np

    from tideline.llm.queries import ORACLES, QUERIES

    rng = np.random.default_rng(4)
    urls, labels = [], []
    for d in range(30):
        bad = d % 3 == 0
        for h in range(6):
            for _ in range(int(rng.integers(1, 30))):
                urls.append((len(urls), f"http://h{h}.d{d}.{'xyz' if bad else 'info'}/p"))
                if h < 4:
                    labels.append((len(urls) - 1, int(rng.random() > (0.97 if bad else 0.05)), 0))
    urls += [(9000, "http://new.xyz/"), (9001, "http://a.b.else/"), (9002, "http://1.2.3.4/"), (9003, None), (9004, "http://h9.d0.co.uk/")]
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = sorted(map(str, map(tuple, QUERIES["op1_url_filter"](spark, str(tmp_path)).collect())))
    assert got == sorted(map(str, con.execute(ORACLES["op1_url_filter"]).fetchall()))
    assert any("h5.d0.xyz" in x and "'block'" in x for x in got) and any("h5.d1.info" in x and "'allow'" in x for x in got)
