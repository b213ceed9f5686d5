"""Quality classifier: a boosted additive model with pairwise interactions over text statistics.

Features are computed for all texts of an Arrow batch at once from its bytes. The model
is fitted on the driver from a bounded sample of labelled rows (``SAMPLE_ROWS`` rows of
``len(FEATURES)`` numbers; no texts are collected) and is a few kilobytes of tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extended, release, restored, set_aside, text_or_empty, without
from .gam import Gam, fit
from .shingles import IS_SPACE, KEEP_CASE, batches_by_bytes, clean_words, filled, text_offsets, xxh64

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
ADDED = ("quality_score", "quality_ok")
#: Text bytes handled at once; the arrays of a step then stay in the processor's cache.
STEP_BYTES = 256 << 10

#: Byte classes counted per text, as shares of all bytes (the rest is "other").
CLASSES = {
    "other": (),
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "space": [0x20, 0x09, *range(0x0B, 0x0E)],
    "newline": [0x0A],
    "stop": b".,;:?'\"",
    "bang": b"!",
    "bar": b"|",
    "mark": b"#$%&*+/<=>@[\\]^_`{}~",
    "wide": range(0x80, 0x100),
}
CLASS_OF = np.zeros(256, np.int64)
for _k, _members in enumerate(CLASSES.values()):
    CLASS_OF[list(_members)] = _k
#: Three counters in one number for the bytes of a word: upper case, lower case, marks.
FIELD = (1 << 21) - 1
IN_WORD = np.zeros(256, np.int64)
for _name, _shift in (("upper", 0), ("lower", 21), ("mark", 42)):
    IN_WORD[list(CLASSES[_name])] = 1 << _shift
FEATURES = (
    "log_bytes", "log_words", *(f"{k}_share" for k in list(CLASSES)[1:]), "word_length", "longest_word", "short_words",
    "distinct_words", "echoed_words", "repeated_pairs", "repeated_lines", "line_words", "shouted_words", "marked_words",
)


def _sum_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of different keys of each row."""
    with np.errstate(over="ignore"):
        mixed = keys ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(mixed, return_index=True)
    return np.bincount(row[at], minlength=rows)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; all shares of an empty text are 0. No nulls."""
    n = len(texts)
    offsets = text_offsets(texts)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    at = offsets - offsets[0]
    size = np.maximum(np.diff(at), 1)
    out = [np.log1p(np.diff(at))]
    buf, starts, ends, first = clean_words(texts, KEEP_CASE)
    words = np.diff(first)
    some = np.maximum(words, 1)
    out.append(np.log1p(words))
    byte_row = np.repeat(np.arange(n, dtype=np.int64) * len(CLASSES), np.diff(at))
    counts = np.bincount(byte_row + CLASS_OF[raw], minlength=n * len(CLASSES)).reshape(n, len(CLASSES))
    out += list((counts / size[:, None]).T[1:])
    lengths = ends - starts
    out.append(_sum_by_row(lengths, first) / some)
    longest = np.zeros(n)
    full = np.flatnonzero(words)
    if len(full):
        longest[full] = np.maximum.reduceat(lengths, first[full])
    out.append(np.log1p(longest))
    out.append(_sum_by_row(lengths <= 3, first) / some)
    row = np.repeat(np.arange(n), words)
    hashes = xxh64(buf, starts, ends, 42)
    out.append(_distinct(hashes, row, n) / some)
    same_row = row[1:] == row[:-1]
    echo = np.concatenate((np.zeros(min(1, len(row)), bool), (hashes[1:] == hashes[:-1]) & same_row))
    out.append(_sum_by_row(echo, first) / some)
    with np.errstate(over="ignore"):
        pair = hashes[:-1] * np.uint64(3) + hashes[1:]
    pair, pair_row = pair[same_row], row[:-1][same_row]
    pairs = np.bincount(pair_row, minlength=n)
    out.append(1 - _distinct(pair, pair_row, n) / np.maximum(pairs, 1))
    # Lines by the sum of their words' hashes; a line ends where a newline lies between two words.
    lines, repeated = _lines(raw, at, hashes, row, first, n)
    out.append(repeated / np.maximum(lines, 1))
    out.append(np.log1p(words / np.maximum(lines, 1)))
    inside = np.add.reduceat(IN_WORD[buf], starts) if len(starts) else np.zeros(0, np.int64)
    upper, lower, marks = inside & FIELD, inside >> 21 & FIELD, inside >> 42
    out.append(_sum_by_row((upper >= 2) & (lower == 0), first) / some)
    out.append(_sum_by_row(marks > 0, first) / some)
    return np.column_stack(out) if n else np.zeros((0, len(FEATURES)))


def _lines(raw, at, hashes, row, first, n) -> tuple[np.ndarray, np.ndarray]:
    """Non-empty lines of each row, and how many of them repeat an earlier one."""
    if not len(hashes):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    newlines = np.concatenate(([0], np.cumsum(raw == 0x0A)))
    space = IS_SPACE[raw]
    begins = ~space
    begins[1:] &= space[:-1]
    inner = at[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    begins[inner] = ~space[inner]
    line_no = newlines[np.flatnonzero(begins)]
    fresh = np.concatenate(([True], (line_no[1:] != line_no[:-1]) | (row[1:] != row[:-1])))
    heads = np.flatnonzero(fresh)
    with np.errstate(over="ignore"):
        mark = np.add.reduceat(hashes * np.uint64(0xD6E8FEB86659FD93), heads)
    line_row = row[heads]
    lines = np.bincount(line_row, minlength=n)
    return lines, lines - _distinct(mark, line_row, n)


def _feature_stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batches_by_bytes(batch, "text", STEP_BYTES):
            made = features(part.column("text"))
            lists = pa.ListArray.from_arrays(
                np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), np.ascontiguousarray(made).ravel()
            )
            yield pa.RecordBatch.from_arrays([part.column("y"), lists], ["y", "x"])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Gam:
    """Fit on at most ``sample_rows`` labelled rows: those of the smallest hashed ids.

    ``train`` is a condition on the labels table (all rows if None). Rows without a
    0/1 label or without a document do not count; of repeated labels each counts.
    """
    chosen = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    chosen = chosen.filter(train) if train is not None else chosen
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col, label_col).limit(sample_rows)
    # sample_rows pairs of numbers at most: a bounded broadcast.
    chosen = F.broadcast(chosen.select(F.col(id_col).alias("__tl_id"), F.col(label_col).cast("int").alias("y")))
    slim = docs.select(F.col(id_col).alias("__tl_doc"), text_or_empty(text_col).alias("text"))
    rows = slim.join(chosen, F.col("__tl_doc") == F.col("__tl_id")).select("y", "text")
    table = rows.mapInArrow(_feature_stage, "y int, x array<double>").toArrow()
    y = table.column("y").to_numpy().astype(np.float64)
    flat = table.column("x").combine_chunks().flatten().to_numpy() if len(y) else np.zeros(0)
    x = flat.reshape(len(y), len(FEATURES))
    order = np.lexsort((y, *x.T))  # sums of numbers depend on their order, which tasks must not decide
    return fit(x[order], y[order])


def score_quality(
    docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """All rows and columns of ``docs`` plus ``quality_score`` (0 to 1) and ``quality_ok``.

    Null texts score like empty ones. Repeated rows score alike. Input columns of these
    names are replaced.
    """

    slim = without(docs, *ADDED)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in batches_by_bytes(batch, text_col, STEP_BYTES):
                p = model.probability(features(filled(part.column(text_col))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], [*part.schema.names, "quality_score"])

    scored = slim.mapInArrow(stage, extended(slim, quality_score="double"))
    return scored.withColumn("quality_ok", F.col("quality_score") >= threshold)


def drop_poor(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that :func:`score_quality` accepts, with the columns of ``docs`` only (clashing names survive too)."""
    inner, new = set_aside(docs, *ADDED)
    return restored(score_quality(inner, model, new[id_col], new[text_col], threshold).filter("quality_ok"), new)
