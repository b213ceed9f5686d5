"""The registered queries against their contracts, and the pipeline."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tideline.llm.queries import ORACLES, QUERIES, SHARDS, tokenizer_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_names():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert set(ORACLES) <= set(QUERIES)


def test_shards(spark, texts):
    rows = QUERIES["op5_histogram_shards"](spark, SF).collect()
    assert len(rows) == len(texts)
    load = Counter()
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        load[r["shard"]] += r["size"]
    assert len(load) <= SHARDS


def test_packing(spark, texts):
    lib = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    found = defaultdict(list)
    for r in QUERIES["op8_pack"](spark, SF).collect():
        found[r["doc_id"]].append(r)
    for doc, text in texts.items():
        want = lib.encode(text, add_special_tokens=False).ids + [1]
        for r in found[doc]:
            piece = want[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in piece))
        assert sum(r["length"] for r in found[doc]) == len(want) == found[doc][0]["doc_tokens"]


@pytest.mark.parametrize("name", ["op6_toxic_spans", "op9_quality"])
def test_scores(spark, texts, name):
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == len(texts)
    modulus, held = (4, 2) if name.startswith("op6") else (5, 0)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_pieces(spark, texts):
    rows = QUERIES["op4_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] for r in rows)


def test_pipeline(spark, texts):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
        after = docs.count()
        assert 0.5 * before < after <= before, name
        before = after
    kept = {r["doc_id"] for r in docs.collect()}
    assert len({texts[d] for d in kept}) == len(kept)
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == kept


def grams(text, n=5):
    """Distinct n-word shingles, lower-cased as the operator does."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def similar_pairs(texts):
    """Jaccard similarity of all pairs that share a shingle."""
    sets, holders, shared = {d: grams(t) for d, t in texts.items()}, defaultdict(list), Counter()
    for d, some in sets.items():
        for g in some:
            holders[g].append(d)
    for some in holders.values():
        for i, a in enumerate(sorted(some)):
            for b in sorted(some)[i + 1 :]:
                shared[a, b] += 1
    return {(a, b): n / (len(sets[a]) + len(sets[b]) - n) for (a, b), n in shared.items()}


def test_dedup_stages_against_brute_force(spark):
    """Exact stage: one row of each text. Near stage: close pairs lose one, and nothing goes without a close one."""
    sf = "/root/testdata/sf0.01"
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    last = {}
    for d in sorted(texts):
        last[texts[d]] = d
    unique = {r["doc_id"] for r in stages["exact_dedup"](spark, docs, sf).collect()}
    assert unique == set(last.values())
    before = docs.filter(docs["doc_id"].isin(*unique))
    kept = {r["doc_id"] for r in stages["near_dedup"](spark, before, sf).select("doc_id").collect()}
    pairs = similar_pairs({d: texts[d] for d in unique})
    assert not [p for p, s in pairs.items() if s >= 0.8 and p[0] in kept and p[1] in kept]
    for gone in unique - kept:
        assert max((s for p, s in pairs.items() if gone in p), default=0) >= 0.8


ODD_ROWS = [
    (1, None, "en", "s", 0), (2, "", None, "s", None), (None, "no id " * 30, "en", None, 1), (None, "no id " * 30, "en", None, 1), (4, " \n\t", "xx", "", 3),
    (5, "same text here " * 20, "en", "s", 9), (5, "same text here " * 20, "en", "s", 9), (6, "same text here " * 20, "de", "t", 9),
    (7, "word " * 200_000, "en", "s", 1), (8, "x" * 1_000_000, "en", "s", 1), (9, "日本語" * 50_000, "ja", "s", 1),
]


@pytest.mark.parametrize("rows", [ODD_ROWS, []], ids=["odd", "empty"])
def test_stages_on_odd_rows(spark, rows):
    """Nulls in any column, empty and very long texts, repeated rows, an empty table, and columns named like the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    clash = {"kept": "'k'", "keep_id": "1", "group_size": "2", "quality_score": "'q'", "quality_ok": "false", "toxic": "'t'", "toxic_spans": "3", "component_id": "4", "u": "5", "start": "6", "offset": "7"}
    docs = docs.selectExpr("*", *[f"{v} AS {k}" for k, v in clash.items()])
    whole = Counter(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = Counter(map(str, out.collect()))
        assert not got - whole, name
        if rows and name == "exact_dedup":
            texts = [r["text"] or "" for r in out.collect()]
            assert sorted(texts) == sorted({t or "" for _, t, *_ in rows})
            assert {r["doc_id"] for r in out.collect()} == {2, None, 4, 6, 7, 8, 9}
        if rows and name == "near_dedup":
            # 1, 2 and 4 have no words and are alike; 5 stays with its repeated row, 6 goes; rows without an id stay.
            assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "5", "5", "7", "8", "9", "None", "None"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id", "start", "length", "doc_tokens").collect()
    assert Counter(str(r["doc_id"]) for r in pieces if r["start"] == 0) == Counter(str(d) for d, *_ in rows)


def test_near_stage_recall_on_all_of_sf01(spark):
    """All pairs of the distinct texts of sf0.1 at similarity 0.8 or more lose one; nothing else goes."""
    sf = "/root/testdata/sf0.1"
    docs = corpus_pipeline.exact_stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    pairs = [p for p, s in similar_pairs(texts).items() if s >= 0.8]
    kept = {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, sf).select("doc_id").collect()}
    assert pairs and not [p for p in pairs if p[0] in kept and p[1] in kept]
    partners = {d for p in pairs for d in p}
    assert set(texts) - kept <= partners


def test_run_leaves_only_what_its_result_reads(spark):
    from tideline.llm import common

    before = common.written()
    rows = corpus_pipeline.run(spark, SF).count()
    left = [p for p in common.written() if p not in before]
    assert rows and len(left) <= 2, left
    common.clean_up(spark, before)
    assert common.written() == before
