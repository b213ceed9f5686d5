"""Vectorised tokenising and XXH64 over Arrow string batches.

All texts of a batch are handled as one byte buffer: words are found with array
comparisons, and the 64-bit hash of every shingle is computed for all shingles at
once, so the cost per shingle does not include a Python call.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 20

# XXH64 primes and the six separators of the word pattern: fixed values.
P1, P2, P3, P4, P5 = (
    np.uint64(x)
    for x in (
        0x9E3779B185EBCA87,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)
SPACES = [0x20, *range(0x09, 0x0E)]

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[SPACES] = True
KEEP_CASE = np.arange(256, dtype=np.uint8)
KEEP_CASE[SPACES] = 0x20
FOLD_AZ = KEEP_CASE.copy()
FOLD_AZ[ord("A") : ord("Z") + 1] += 32


def batches_by_bytes(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``limit`` text bytes; a longer text is a slice of its own."""
    offsets = text_offsets(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def filled(array: pa.Array) -> pa.Array:
    """Texts with nulls as empty strings."""
    return pc.fill_null(array, "") if array.null_count else array


def text_offsets(array: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(array.type)
    raw = np.frombuffer(array.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[array.offset : array.offset + len(array) + 1].astype(np.int64)


def clean_words(array: pa.Array, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: (bytes with single spaces, word starts, word ends, first word of each row).

    ``first`` has one entry more than there are rows. The array must not hold nulls.
    """
    offsets = text_offsets(array)
    data = array.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    space = IS_SPACE[raw]
    # A word begins after a space or at the start of a row.
    begins = ~space
    begins[1:] &= space[:-1]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    begins[inner] = ~space[inner]
    if len(raw):
        begins[0] = not space[0]
    ends = ~space
    ends[:-1] &= space[1:]
    ends[inner - 1] = ~space[inner - 1]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    first = np.searchsorted(starts, offsets)
    # Close up: every word followed by exactly one space.
    lengths = stops - starts
    out_starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1] if len(lengths) else np.zeros(0, np.int64)
    out = np.full(int(lengths.sum() + len(lengths)), 0x20, dtype=np.uint8)
    is_word = np.ones(len(out), dtype=bool)
    is_word[out_starts + lengths] = False
    out[is_word] = fold[raw[~space]]
    return out, out_starts, out_starts + lengths, first


def shingle_hashes(
    buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, words: int, seed: int = 42
) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and the number of shingles of each row."""
    n_words = np.diff(first)
    counts = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    total = int(counts.sum())
    base = np.repeat(first[:-1], counts)
    step = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = base + step
    last = np.minimum(begin + words, np.repeat(first[1:], counts)) - 1
    return xxh64(buf, starts[begin], ends[last], seed), counts


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of ``buf[starts[i]:ends[i]]`` for all i at once."""
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    # Unaligned little-endian reads: a 64-bit view at every byte offset.
    words = np.lib.stride_tricks.as_strided(padded, shape=(len(buf) + 1, 8), strides=(1, 1))
    seed64 = np.uint64(seed)
    length = ends - starts
    at = starts.astype(np.int64).copy()

    def lane8(pos: np.ndarray) -> np.ndarray:
        return words[pos].view("<u8").ravel()

    with np.errstate(over="ignore"):
        acc = np.full(n, seed64 + P5, dtype=np.uint64)
        long = np.flatnonzero(length >= 32)
        if len(long):
            v = [np.full(len(long), x, dtype=np.uint64) for x in (seed64 + P1 + P2, seed64 + P2, seed64, seed64 - P1)]
            active = np.arange(len(long))
            while len(active):
                rows = long[active]
                pos = at[rows]
                for k in range(4):
                    v[k][active] = _round(v[k][active], lane8(pos + 8 * k))
                at[rows] += 32
                active = active[at[rows] + 32 <= ends[rows]]
            mix = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                mix = (mix ^ _round(np.zeros_like(x), x)) * P1 + P4
            acc[long] = mix
        acc += length.astype(np.uint64)
        active = np.flatnonzero(at + 8 <= ends)
        while len(active):
            h = acc[active] ^ _round(np.zeros(len(active), np.uint64), lane8(at[active]))
            acc[active] = _rotl(h, 27) * P1 + P4
            at[active] += 8
            active = active[at[active] + 8 <= ends[active]]
        active = np.flatnonzero(at + 4 <= ends)
        if len(active):
            low = lane8(at[active]) & np.uint64(0xFFFFFFFF)
            acc[active] = _rotl(acc[active] ^ (low * P1), 23) * P2 + P3
            at[active] += 4
        active = np.flatnonzero(at < ends)
        while len(active):
            h = acc[active] ^ (buf[at[active]].astype(np.uint64) * P5)
            acc[active] = _rotl(h, 11) * P1
            at[active] += 1
            active = active[at[active] < ends[active]]
        acc ^= acc >> np.uint64(33)
        acc *= P2
        acc ^= acc >> np.uint64(29)
        acc *= P3
        acc ^= acc >> np.uint64(32)
    return acc


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bitwise strict majority of each row's hashes; rows without hashes give 0."""
    out = np.zeros(len(counts), dtype=np.uint64)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return out
    n = counts[rows]
    # Eight bit counters share a word; pieces of at most 255 hashes cannot overflow a byte.
    pieces = (n + 254) // 255
    row_of = np.repeat(np.arange(len(rows)), pieces)
    nth = np.arange(len(row_of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    heads = (np.cumsum(n) - n)[row_of] + nth * 255
    row_heads = np.cumsum(pieces) - pieces
    low = np.uint64(0x0101010101010101)
    fp = np.zeros(len(rows), dtype=np.uint64)
    for k in range(8):
        packed = np.add.reduceat((hashes >> np.uint64(k)) & low, heads)
        per_byte = packed.view(np.uint8).reshape(-1, 8).astype(np.int64)
        totals = np.add.reduceat(per_byte, row_heads, axis=0)
        won = totals * 2 > n[:, None]
        for byte in range(8):
            fp |= won[:, byte].astype(np.uint64) << np.uint64(8 * byte + k)
    out[rows] = fp
    return out
