"""Similar documents against brute force: no pair at the threshold is missed, none below it linked."""

from collections import defaultdict

import numpy as np
import pytest

from tideline.llm import simhash
from tideline.llm.simhash import similar_documents

WORDS = [f"w{i}" for i in range(4000)]


def grams(words, n=5):
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def near_copy(rng, base, how, amount):
    """A copy with ``amount`` times its words appended, cut, or edited one by one."""
    k = max(1, int(amount * len(base)))
    if how == "appended":
        return base + [f"new{rng.integers(10**9)}" for _ in range(k)]
    if how == "foreign":
        return base + [WORDS[i] for i in rng.integers(0, 4000, k)]
    if how == "cut":
        return base[:-k]
    out = list(base)
    for at in rng.choice(len(base), max(1, k // 5), replace=False):
        out[at] = f"new{rng.integers(10**9)}"
    return out


def brute_classes(docs, threshold=0.8):
    sets, parent = {d: grams(w) for d, w in docs.items()}, {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for d, some in sets.items():
        for g in some:
            holders[g].add(d)
    for a in docs:
        for b in {b for g in sets[a] for b in holders[g] if b > a}:
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    classes = defaultdict(set)
    for d in docs:
        classes[root(d)].add(d)
    return {d: c for c, some in classes.items() if len(some) > 1 for d in some}


def found(spark, docs, **kw):
    rows = [(d, " ".join(w)) for d, w in docs.items()]
    return dict(similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), **kw).collect())


def pairs():
    rng = np.random.default_rng(21)
    docs = {}
    for k in range(160):
        how = ("appended", "foreign", "cut", "edited")[k % 4]
        docs[2 * k] = [WORDS[i] for i in rng.integers(0, 4000, int(rng.integers(60, 600)))]
        docs[2 * k + 1] = near_copy(rng, docs[2 * k], how, rng.uniform(0.05, 0.15) if how == "edited" else rng.uniform(0.1, 0.3))
    return docs


def test_no_similar_pair_is_missed(spark):
    docs = pairs()
    want, got = brute_classes(docs), found(spark, docs)
    missed = [d for d in want if got.get(d) != want[d]]
    assert len(want) >= 200 and not missed, f"{len(missed)} of {len(want)}"


def test_nothing_below_the_threshold_is_linked(spark):
    docs = pairs()
    want = brute_classes(docs)
    wrong = set(found(spark, docs)) - set(want)
    assert len(docs) - len(want) >= 20 and not wrong, f"{len(wrong)} of {len(docs) - len(want)}"


@pytest.mark.parametrize("part", [10**6, 2000])
def test_large_groups_in_parts(spark, part):
    """Chains, near copies of one text and of its copies, whether or not they are in one part."""
    rng = np.random.default_rng(5)
    hub = [WORDS[i] for i in rng.integers(0, 4000, 200)]
    docs = {10 * k: near_copy(rng, hub, "edited", rng.uniform(0.05, 0.4)) for k in range(60)}
    for k in range(30):
        docs[10 * k + 1] = near_copy(rng, docs[10 * k], ("appended", "cut", "edited")[k % 3], rng.uniform(0.05, 0.3))
    want = brute_classes(docs)
    assert len(want) > 20 and found(spark, docs, part_shingles=part) == want


def test_dropped_documents_have_a_partner(spark):
    """Of the given documents, those dropped have a partner at 0.8, and no pair at 0.8 stays whole."""
    import corpus_pipeline
    from tests.llm.test_llm_queries import similar_pairs

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").dropDuplicates(["text"]).orderBy("doc_id").toPandas()
    texts = dict(zip(docs["doc_id"], docs["text"].fillna("")))
    near = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = {r["doc_id"] for r in near(spark, spark.createDataFrame(docs), sf).select("doc_id").collect()}
    close = [p for p, s in similar_pairs(texts).items() if s >= 0.8]
    assert close and not [p for p in close if p[0] in kept and p[1] in kept]
    assert set(texts) - kept <= {d for p in close for d in p}


def test_hot_shingles_lose_no_pair(spark, monkeypatch):
    """Every shared shingle hot: rows are joined by salts, and the classes stay the same."""
    monkeypatch.setattr(simhash, "HOT_LEAST", 1)
    monkeypatch.setattr(simhash, "HOT_SHINGLE", 0)
    rng = np.random.default_rng(8)
    docs = pairs()
    hub = [WORDS[i] for i in rng.integers(0, 4000, 120)]
    docs |= {1000 + k: near_copy(rng, hub, "edited", 0.1) for k in range(150)}
    assert found(spark, docs) == brute_classes(docs)
