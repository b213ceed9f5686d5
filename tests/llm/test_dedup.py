"""Exact dedup and SimHash against brute force, edge cases included."""

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import shingles
from tideline.llm.components import components
from tideline.llm.exact_dedup import drop_duplicates, mark_duplicates
from tideline.llm.simhash import drop_similar, link_node, links, near_duplicates, similar_documents

LONG = "long text " * 4000
DOCS = [
    (1, "a"), (2, "a"), (3, ""), (4, None), (5, "a "), (6, LONG), (7, LONG), (8, LONG + "x"), (9, "x" * 32), (10, "x" * 32),
    (11, "x" * 33), (12, "é"), (13, "é"), (None, "lone"), (None, "lone"), (20, "lone"), (21, "dup"), (21, "dup"),
]


def expected_marks(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize(("bucket", "block", "broadcast"), [(1, 32, 16 << 20), (1, 32, 0), (2, 4, 16 << 20), (1000, 1, 0)])
def test_exact_groups(spark, bucket, block, broadcast, monkeypatch):
    """All of the recursion by all executors, all of it inside a bucket, or some of each; keys broadcast or joined."""
    monkeypatch.setattr("tideline.llm.exact_dedup.BROADCAST_BYTES", broadcast)
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    got = mark_duplicates(df, max_hot=10**9, min_bucket_rows=bucket, first_block=block).collect()
    want = expected_marks(DOCS)
    assert len(got) == len(DOCS)
    kept = defaultdict(int)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[r["text"] or ""]
        kept[r["text"] or ""] += r["kept"]
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}


def test_exact_hot_group_and_levels(spark):
    """Groups far over the bucket bound, sharing long beginnings, go down several levels."""
    same = "shared beginning " * 40
    rows = [(i, same) for i in range(60)] + [(100 + i, same + str(i % 30)) for i in range(60)] + [(200, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in mark_duplicates(df, max_hot=10**9, min_bucket_rows=4).collect()}
    want = expected_marks(rows)
    assert all((got[i]["keep_id"], got[i]["group_size"]) == want[t] for i, t in rows)


def test_exact_random_texts(spark):
    """The default path against a dictionary: short alphabets make many shared beginnings of all lengths."""
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 900)), "".join(rng.choice(["a", "b", "é"], int(rng.integers(0, 7))))) for _ in range(900)]
    rows += [(k, "x" * int(rng.integers(30, 36))) for k in range(100)] + [(None, "a"), (None, "zz"), (None, "zz")]
    got = mark_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want, kept = expected_marks(rows), defaultdict(int)
    assert all((r["keep_id"], r["group_size"]) == want[r["text"]] for r in got) and len(got) == len(rows)
    for r in got:
        kept[r["text"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1} and len(kept) == len(want)


def test_exact_very_long_texts(spark):
    """Texts of megabytes that differ in their last byte, or only in length, and copies of them."""
    long = "0123456789abcdef" * 150_000
    rows = [(1, long), (2, long), (3, long + "x"), (4, long + "y"), (5, long + "x"), (6, long[:-1])]
    for bucket in (1, 200):
        got = mark_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), min_bucket_rows=bucket, max_hot=10**9)
        assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in got.select("doc_id", "keep_id", "group_size").collect()} == {
            1: (2, 2), 2: (2, 2), 3: (5, 2), 5: (5, 2), 4: (4, 1), 6: (6, 1)
        }


def test_exact_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert mark_duplicates(empty).count() == 0
    clash = spark.createDataFrame([(1, "a", "x", 5), (2, "a", "y", 6)], "doc_id long, text string, kept string, keep_id int")
    marked = mark_duplicates(clash)
    assert marked.columns == ["doc_id", "text", "keep_id", "group_size", "kept"]
    assert [tuple(r) for r in drop_duplicates(clash).collect()] == [(2, "a", "y", 6)]
    assert drop_duplicates(clash).columns == clash.columns


# ---------------------------------------------------------------- hashing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abZ é\n\t xyzA日", max_size=90), max_size=6), st.integers(1, 5))
def test_fingerprints_match_brute_force(texts, words):
    import pyarrow as pa

    buf, starts, ends, first = shingles.clean_words(pa.array(texts, pa.string()), shingles.FOLD_AZ)
    hashes, counts = shingles.shingle_hashes(buf, starts, ends, first, words)
    prints = shingles.majority_bits(hashes, counts)
    for text, fp in zip(texts, prints.tolist()):
        assert fp == brute_fingerprint(text, words)


def brute_fingerprint(text, words):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    grams = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_long_hash_lanes():
    data = bytes(range(256)) * 3
    buf = np.frombuffer(data, np.uint8)
    starts = np.arange(0, 200)
    ends = starts + np.arange(200) * 2
    got = shingles.xxh64(buf, starts, ends, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[s:e], 42) for s, e in zip(starts, ends)]


# ---------------------------------------------------------------- links


def brute_components(ids):
    ids = list(ids)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    return parent, find


def classes(fps, distance=2):
    parent, find = brute_components(range(len(fps)))
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= distance) + i + 1
        for j in near.tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def clustered(seed, clusters=20, size=30, spread=3, loose=200):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, clusters, dtype=np.uint64)
    out = list(base) + list(rng.integers(0, 2**63, loose, dtype=np.uint64))
    for b in base:
        x = b
        for _ in range(size):
            for _ in range(rng.integers(1, spread + 1)):
                x = x ^ np.uint64(1 << int(rng.integers(0, 64)))
            out.append(x)
    return np.unique(np.array(out, dtype=np.uint64))


@pytest.mark.parametrize("seed", range(4))
def test_node_forest(seed):
    fps = clustered(seed)
    pairs = link_node(fps)
    assert all(np.bitwise_count(fps[i] ^ fps[j]) <= 2 for i, j in pairs)
    parent, find = brute_components(range(len(fps)))
    for i, j in pairs:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == classes(fps)


@pytest.mark.parametrize("sizes", [{}, {"node_rows": 40}, {"node_rows": 12}])
def test_links_keep_components(spark, sizes):
    """Whole nodes, and nodes split by more bits once or several times, find the same classes."""
    fps = clustered(7)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "__tl_fp long")
    edges = links(df, 2, **sizes).collect()
    at = {int(f): k for k, f in enumerate(fps.view(np.int64))}
    parent, find = brute_components(range(len(fps)))
    for e in edges:
        assert bin((e["u"] ^ e["v"]) & 2**64 - 1).count("1") <= 2
        a, b = find(at[e["u"]]), find(at[e["v"]])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == classes(fps)


def test_hot_fingerprint(spark):
    """A text that most rows share is joined to its class without moving its rows; copies of it all link."""
    rows = [(k, "same words in all of these") for k in range(400)] + [(1000 + k, f"other text number {k} {k * k} here") for k in range(9)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {r["component_id"] for r in got if r["doc_id"] < 400} == {0}
    assert all(r["component_id"] == r["doc_id"] for r in got if r["doc_id"] >= 1000)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 201), (201, 200)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_large_stars(spark):
    """Two centres with very many neighbours, met by a chain."""
    edges = [(9, k) for k in range(100, 3100)] + [(k, 5) for k in range(5000, 8000)] + [(8000 + k, 8001 + k) for k in range(40)]
    edges += [(3099, 8040)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    parent, find = brute_components(range(8050))
    for u, v in edges:
        parent[find(u)] = find(v)
    groups = {}
    for x in {x for e in edges for x in e}:
        groups.setdefault(find(x), []).append(x)
    assert got == {x: min(g) for g in groups.values() for x in g}


TEXTS = [
    (5, "the quick brown fox jumps over the lazy dog again"), (3, "THE quick brown fox  jumps over the lazy dog again"), (9, ""), (8, None),
    (7, " \n"), (1, "something else entirely here"), (2, "word"), (2, "word"), (None, "word"),
    (30, " ".join(f"w{i}" for i in range(3000))), (31, " ".join(f"w{i}" for i in range(3001))),
]


def test_near_duplicates(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    got = near_duplicates(df).collect()
    assert len(got) == len(TEXTS)
    fps = [brute_fingerprint(t, 3) for _, t in TEXTS]
    comp = classes(np.array(fps, dtype=np.uint64))
    least = defaultdict(list)
    for c, (i, _) in zip(comp, TEXTS):
        if i is not None:
            least[c].append(i)
    want = sorted((str(i), f"{fp:016x}", min(least[c])) for (i, _), fp, c in zip(TEXTS, fps, comp))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want
    assert near_duplicates(df.limit(0)).count() == 0


def edited(rng, words, share):
    out = list(words)
    for at in rng.choice(len(out), max(1, int(len(out) * share)), replace=False):
        out[at] = f"edit{rng.integers(10**6)}"
    return out


def jaccard(a, b, n=5):
    grams = [{tuple(x[i : i + n]) for i in range(max(1, len(x) - n + 1))} for x in (a, b)]
    return len(grams[0] & grams[1]) / len(grams[0] | grams[1])


def test_similar_documents(spark):
    """Close copies are found, unrelated and distant texts are left alone."""
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts, near, far = [], [], []
    for k in range(60):
        base = [vocabulary[i] for i in (rng.zipf(1.3, 300) - 1) % 3000]
        texts.append((10 * k, base))
        for c, share in ((1, 0.004), (2, 0.01), (3, 0.3)):
            copy = edited(rng, base, share)
            texts.append((10 * k + c, copy))
            (near if jaccard(base, copy) >= 0.88 else far).append((10 * k, 10 * k + c))
    rows = [(i, " ".join(w)) for i, w in texts] + [(9000, None), (9001, ""), (None, "alone"), (9002, "alone"), (9003, "few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS component_id", "2 AS u")
    found = dict(similar_documents(df).collect())
    assert sum(found.get(a, a) == found.get(b, b) for a, b in near) >= 0.97 * len(near)
    assert all(found.get(b, b) == b for _, b in far if (b - 3) % 10 == 0)
    assert {found.get(i, i) // 10 for i, _ in texts} == set(range(60))  # no class joins two bases
    assert found[9000] == found[9001] == 9000 and 9002 not in found
    kept = drop_similar(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None in ids and set(ids) == {i for i, _ in rows if found.get(i, i) == i}
    assert similar_documents(df.limit(0)).count() == 0 and drop_similar(df.limit(0)).count() == 0
