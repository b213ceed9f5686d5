"""Sequence packing: first-fit decreasing over a tournament tree of bin capacities.

Documents are dealt into randomised groups of bounded bytes by a hash of their
id, one exchange in all, and sorted by id in each. Groups are tokenised as they stream
by, and each is packed on its own: a document of ``length`` ids or more gives full pieces
first, and the remainders, longest first, go each to the first open sequence with room. A
tournament tree holds the largest free space under every node, so finding that sequence
takes one descent. Of a group only the ids of the remainders are held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, text_or_empty
from .wordbpe import WordTokenizer

LENGTH = 2048
END_ID = 1
GROUP_BYTES = 8 << 20
STEP_BYTES = 256 << 10
OUT_BYTES = 4 << 20
SCHEMA = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Where a long text may be cut: white space to the host language and the tokenizer alike.
BORDER = regex.compile(r"[ \t\n\r]")


class TournamentTree:
    """Capacities of bins in opening order; each inner node holds the larger of its two."""

    def __init__(self, size: int, capacity: int):
        self.base = 1 << max(0, (max(size, 1) - 1).bit_length())
        self.best = [capacity] * (2 * self.base)

    def first_fit(self, need: int) -> int:
        """Index of the first bin with ``need`` free, which is then taken from it."""
        best, node = self.best, 1
        while node < self.base:
            node *= 2
            if best[node] < need:
                node += 1
        best[node] -= need
        found = node - self.base
        while node > 1:
            node //= 2
            top = max(best[2 * node], best[2 * node + 1])
            if best[node] == top:
                break
            best[node] = top
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of every length; ties keep the given order."""
    order = np.argsort(-lengths, kind="stable")
    tree = TournamentTree(len(lengths), capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: dict[int, int] = {}
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        b = tree.first_fit(need)
        bins[i], offsets[i] = b, used.get(b, 0)
        used[b] = used.get(b, 0) + need
    return bins, offsets


def slices(text: str, size: int = STEP_BYTES) -> Iterator[str]:
    """A long text in parts of about ``size`` characters, cut at white space, which has no ids."""
    at = 0
    while len(text) - at > size:
        border = BORDER.search(text, at + size)
        if border is None:
            break
        yield text[at : border.start()]
        at = border.end()
    yield text[at:]


def _encoded(texts: list[str], tokenizer: WordTokenizer) -> Iterator[bytes]:
    """Ids of each text; about STEP_BYTES of texts are cut into words at once."""
    step, size = [], 0
    for text in texts:
        if len(text) > 2 * STEP_BYTES:
            yield from tokenizer.encode_batch(step)
            yield b"".join([tokenizer.encode_batch([part])[0] for part in slices(text)])
            step, size = [], 0
            continue
        step.append(text)
        size += len(text)
        if size >= STEP_BYTES:
            yield from tokenizer.encode_batch(step)
            step, size = [], 0
    if step:
        yield from tokenizer.encode_batch(step)


class Group:
    """One group's pieces: full ones at once, the remainders when all documents are in."""

    def __init__(self, number: int, tokenizer: WordTokenizer, length: int, end_id: int):
        self.number, self.tokenizer, self.length = number, tokenizer, length
        self.end = np.asarray([end_id], dtype="<u4").tobytes()
        self.full, self.rest = 0, []

    def add(self, ids: list, texts: list[str]) -> Iterator[tuple]:
        width = 4 * self.length
        for doc, data in zip(ids, _encoded(texts, self.tokenizer)):
            data += self.end
            tokens = len(data) // 4
            cut = len(data) - len(data) % width
            for at in range(0, cut, width):
                yield doc, at // 4, self.length, data[at : at + width], tokens, (self.number << 32) + self.full, 0
                self.full += 1
            if cut < len(data):
                self.rest.append((doc, cut // 4, (len(data) - cut) // 4, data[cut:], tokens))

    def finish(self) -> Iterator[tuple]:
        bins, offsets = first_fit_decreasing(np.array([r[2] for r in self.rest], dtype=np.int64), self.length)
        for piece, b, offset in zip(self.rest, bins.tolist(), offsets.tolist()):
            yield *piece, (self.number << 32) + self.full + b, offset
        self.rest = []


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: WordTokenizer, length: int, end_id: int) -> Iterator[tuple]:
    """Pieces of all groups; rows arrive sorted by group."""
    now: Group | None = None
    for batch in batches:
        groups = batch.column("__tl_group").to_numpy()
        heads = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if len(groups) else []
        for a, z in zip(heads, [*heads[1:], len(groups)]):
            if now is None or now.number != groups[a]:
                if now is not None:
                    yield from now.finish()
                now = Group(int(groups[a]), tokenizer, length, end_id)
            run = batch.slice(a, z - a)
            yield from now.add(run.column("doc_id").to_pylist(), run.column("text").to_pylist())
    if now is not None:
        yield from now.finish()


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    group_bytes: int = GROUP_BYTES,
    cache_bytes: int | None = None,
) -> DataFrame:
    """Pieces of all documents: id, start, length, ids (binary, little-endian 32-bit), doc_tokens,
    sequence_id, offset.

    Each document is its ids and ``end_id``; an empty or null text is ``end_id`` alone. Every
    id lies in exactly one piece. Pieces of a sequence are gapless from offset 0 and
    sum to at most ``length``. Rows with one id are separate documents. Rows with
    null ids are packed like others. An empty table gives no pieces. ``tokenizer_path``
    must name the same file on all machines. Sequence ids are unique, not dense. Each worker remembers
    up to ``cache_bytes`` of words (default ``wordbpe.CACHE_BYTES``); the result does not depend on it.

    A group's documents are taken by ascending id, then text, and remainders of one length
    keep that order, so a group computed again gives the same sequences and offsets.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    # The text is part of the hash so that repeated ids spread too.
    dealt = slim.withColumn("__tl_group", F.pmod(F.xxhash64("doc_id", "text", F.lit("pack")), F.lit(groups)))
    dealt = dealt.repartition("__tl_group").sortWithinPartitions("__tl_group", "doc_id", "text")
    doc_type = slim.select("doc_id").limit(0).toArrow().schema.field(0).type
    arrow = pa.schema(
        [("doc_id", doc_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
         ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held(f"pack {tokenizer_path}", lambda: WordTokenizer(tokenizer_path, cache_bytes))
        rows, size = [], 0
        for piece in _pieces(batches, tokenizer, length, end_id):
            rows.append(piece)
            size += len(piece[3]) + 64
            if size > OUT_BYTES:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    return dealt.mapInArrow(stage, SCHEMA.format(id=id_type))
