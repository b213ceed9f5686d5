"""SentencePiece, the word tokenizer and packing against the libraries and by round trip."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import packing, sentencepieces, wordbpe

public = pytest.importorskip("public_tokenizers")
BPE = str(public.path("word_bpe_49k.json"))
PIECES = str(public.path("piece_bpe_32k.model"))
TEXTS = [
    "", " ", "Hello  World", "  lead", "trail ", "\n\n a\tb\r\n", "日本語 text 😀 ok", "don't it's WE'LL", "x" * 300, "ab" * 2000, "ÀÉ naïve Straße",
    "é composed", "ΑΣ ΟΔΟΣ", "a\x1cb c", "<|endoftext|> x<|startoftext|>y", "1234 5.6%", "end.", "İstanbul", "a b c", "▁mark ▁",
    " ".join(f"tok{i}" for i in range(5000)),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


TABLE = sentencepieces.PieceTable(PIECES)
WORDS = wordbpe.WordTokenizer(BPE)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_word_ids(library):
    assert [ids(x) for x in WORDS.encode_batch(TEXTS)] == [e.ids for e in library.encode_batch(TEXTS, add_special_tokens=False)]


def test_piece_ids(processor):
    got = TABLE.encode_batch(TEXTS)
    assert [ids(x) for x in got] == processor.encode(TEXTS)
    assert [TABLE.decode(x) for x in got] == [t.replace("▁", " ") for t in TEXTS]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(texts):
    from tokenizers import Tokenizer

    texts = [t for t in texts if "\x00" not in t]
    lib = _lib.setdefault("t", None) or _lib.__setitem__("t", Tokenizer.from_file(BPE)) or _lib["t"]
    assert [ids(x) for x in WORDS.encode_batch(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    import sentencepiece

    sp = _lib.get("s") or _lib.setdefault("s", sentencepiece.SentencePieceProcessor(model_file=PIECES))
    got = TABLE.encode_batch(texts)
    assert [ids(x) for x in got] == sp.encode(texts)
    assert [TABLE.decode(x) for x in got] == [t.replace("▁", " ") for t in texts]


_lib: dict = {}


def test_encode_frames(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "ids")
    out = sentencepieces.decode(sentencepieces.encode(df.withColumn("decoded", df["ids"]), PIECES), PIECES)
    assert out.columns == ["text", "ids", "decoded"]
    assert all(r["decoded"] == (r["text"] or "").replace("▁", " ") for r in out.collect())
    assert sentencepieces.encode(df.limit(0), PIECES).count() == 0


def test_long_texts_in_slices(library, processor, monkeypatch):
    """Texts and words far longer than a step, cut small here, and one of megabytes as it is."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefgh  ▁\n日本語中é"))
    texts = ["".join(rng.choice(letters, 30_000)), "ab" * 9000, "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 9000))), "\U0001F600\U0001F601" * 4000, " " * 5000 + "x" + "  y" * 3000]
    for name, value in (("PART_CHARS", 500), ("STEP_BYTES", 700)):
        monkeypatch.setattr(sentencepieces, name, value)
    assert [ids(x) for x in TABLE.encode_batch(texts)] == processor.encode(texts)
    monkeypatch.setattr(packing, "STEP_BYTES", 700)
    plain = [t.replace("▁", "_") for t in texts]
    assert [ids(x) for x in packing._encoded(plain, WORDS)] == [e.ids for e in library.encode_batch(plain, add_special_tokens=False)]
    monkeypatch.undo()
    whole = " ".join(f"word{i % 5000} x{i}" for i in range(200_000))
    assert ids(TABLE.encode_batch([whole])[0]) == processor.encode(whole)
    assert ids(next(packing._encoded([whole], WORDS))) == library.encode(whole, add_special_tokens=False).ids


def test_caches_are_bounded(monkeypatch):
    """Forgetting the words learned so far changes no ids."""
    monkeypatch.setattr(wordbpe, "CACHE_BYTES", 5000)
    monkeypatch.setattr(sentencepieces, "CACHE_BYTES", 5000)
    words, pieces = wordbpe.WordTokenizer(BPE), sentencepieces.PieceTable(PIECES)
    for k in range(20):
        texts = [f"some words number{k} and{i} more{k * i}" for i in range(40)]
        assert words.encode_batch(texts) == WORDS.encode_batch(texts) and pieces.encode_batch(texts) == TABLE.encode_batch(texts)
        assert words.known_bytes < 30_000 and pieces.known_bytes < 30_000


# ---------------------------------------------------------------- packing


def test_packing_is_reproducible(spark):
    """The same rows in another order and other partitions give the same sequences and offsets."""
    rows = [(k % 40 or None, f"text {k % 90} " * (k % 13)) for k in range(300)]
    made = []
    for some, parts in ((rows, 1), (rows[::-1], 7)):
        df = spark.createDataFrame(some, "doc_id long, text string").repartition(parts)
        made.append(Counter(map(str, packing.pack(df, BPE, length=64, group_bytes=3000).collect())))
    assert made[0] == made[1]



def brute_first_fit(lengths, capacity):
    room, bins = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(capacity)
        room[b] -= lengths[i]
        bins[i] = b
    return bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths, np.int64), 50)
    assert bins.tolist() == brute_first_fit(lengths, 50)
    spans = defaultdict(list)
    for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths):
        spans[b].append((o, n))
    for some in spans.values():
        at = 0
        for o, n in sorted(some):
            assert o == at
            at += n
        assert at <= 50


@pytest.mark.parametrize("group_bytes", [16 << 20, 2000])
def test_pack(spark, library, group_bytes):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(50, None), (51, "dup"), (51, "dup"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS start", "'x' AS offset")
    out = packing.pack(df, BPE, length=64, group_bytes=group_bytes).collect()
    docs, bins = defaultdict(list), defaultdict(list)
    for r in out:
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= 64
        docs[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in rows:
        if doc == 51:
            continue
        parts = sorted(docs[doc])
        want = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert ids(b"".join(p for _, p, _ in parts)) == want
        assert {n for _, _, n in parts} == {len(want)}
        at = 0
        for start, piece, _ in parts:
            assert start == at
            at += len(piece) // 4
    assert len(docs[51]) == 2
    for some in bins.values():
        at = 0
        for o, n in sorted(some):
            assert o == at
            at += n
        assert at <= 64
    assert packing.pack(df.limit(0), BPE).count() == 0
