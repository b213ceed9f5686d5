"""Binary records of whole Arrow batches at once, with numpy: the fast form of the encoder and decoder.

A record is a row of byte runs, one or more for each field. Encoding makes, for every run, the bytes and
their number in each row, then lays all rows out in one buffer. Decoding walks the fields with
one position for each row. Only flat records are handled; a decoder that meets a branch other than
null and the plain value says so, and the caller decodes that batch value by value.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .wire import NAMED

DAY_MICROS = 86_400_000_000


class OtherBranch(ValueError):
    """A value that is neither null nor of the field's plain type."""


class Damaged(ValueError):
    """Bytes that end too early or too late, or a length below zero."""


# ---------------------------------------------------------------- encoding


class Run:
    """Bytes of one run for all rows: ``data`` is (rows x width), or flat with ``lengths`` bytes a row."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self.data, self.lengths = data, lengths

    def where(self, keep: np.ndarray) -> Run:
        """Empty in the rows not kept; for flat data these must be empty already."""
        return Run(self.data, np.where(keep, self.lengths, 0))

    def put(self, out: np.ndarray, at: np.ndarray) -> None:
        if self.data.ndim == 2:
            for k in range(self.data.shape[1]):
                rows = np.flatnonzero(self.lengths > k)
                out[at[rows] + k] = self.data[rows, k]
            return
        heads = np.cumsum(self.lengths) - self.lengths
        out[np.repeat(at - heads, self.lengths) + np.arange(len(self.data))] = self.data


def varints(values: np.ndarray) -> Run:
    """Zig-zag varints of 64-bit integers."""
    values = values.astype(np.int64)
    rest = ((values << 1) ^ (values >> 63)).view(np.uint64)
    width = max(1, -(-int(rest.max(initial=0)).bit_length() // 7))
    data, lengths = np.zeros((len(values), width), np.uint8), np.ones(len(values), np.int64)
    for k in range(width):
        low = (rest & np.uint64(0x7F)).astype(np.uint8)
        rest = rest >> np.uint64(7)
        more = rest != 0
        data[:, k] = low | (more.astype(np.uint8) << 7)
        lengths += more
    return Run(data, lengths)


def _days(days: np.ndarray) -> list[np.ndarray]:
    date = days.astype("datetime64[D]")
    month = date.astype("datetime64[M]")
    return [month.astype("datetime64[Y]").astype(np.int64) + 1970, month.astype(np.int64) % 12 + 1, (date - month.astype("datetime64[D]")).astype(np.int64) + 1]


def _clock(micros: np.ndarray) -> list[np.ndarray]:
    rest = micros % DAY_MICROS
    return [rest // 3_600_000_000, rest // 60_000_000 % 60, rest // 1_000_000 % 60, rest % 1_000_000]


def _numbers(column: pa.Array, to: pa.DataType) -> np.ndarray:
    return pc.fill_null(column.cast(to), 0).to_numpy(zero_copy_only=False)


def _runs(column: pa.Array, kind: str) -> list[Run]:
    n = len(column)
    if kind in ("int", "long"):
        return [varints(_numbers(column, pa.int64()))]
    if kind == "boolean":
        bits = pc.fill_null(column, False).to_numpy(zero_copy_only=False)
        return [Run(bits.astype(np.uint8)[:, None], np.ones(n, np.int64))]
    if kind in ("float", "double"):
        dtype, arrow, size = ("<f4", pa.float32(), 4) if kind == "float" else ("<f8", pa.float64(), 8)
        raw = pc.fill_null(column.cast(arrow), 0.0).to_numpy(zero_copy_only=False).astype(dtype)
        return [Run(np.ascontiguousarray(raw).view(np.uint8).reshape(n, size), np.full(n, size))]
    if kind in ("bytes", "string"):
        some = pc.fill_null(column.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(some.buffers()[1], np.int64)[some.offset : some.offset + n + 1]
        data = some.buffers()[2]
        flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
        lengths = np.diff(offsets)
        return [varints(lengths), Run(flat, lengths)]
    if kind == "Date":
        return [varints(x) for x in _days(_numbers(column.cast(pa.int32()), pa.int64()))]
    micros = _numbers(column.cast(pa.timestamp("us")).cast(pa.int64()), pa.int64())
    parts = [*_days(micros // DAY_MICROS), *_clock(micros)]
    if kind == "DateTimeTZ":
        parts.append(np.zeros(n, np.int64))
    return [varints(x) for x in parts]


def encode(columns: Sequence[pa.Array], kinds: Sequence[str], rows: int) -> pa.Array:
    """Records of nullable fields as a binary array; no fields: the dummy field, null."""
    runs: list[Run] = []
    one = np.ones(rows, np.int64)
    for column, kind in zip(columns, kinds):
        there = pc.is_valid(column).to_numpy(zero_copy_only=False)
        runs.append(Run((there * np.uint8(2)).astype(np.uint8)[:, None], one))
        runs += [r.where(there) for r in _runs(column, kind)]
    if not kinds:
        runs.append(Run(np.zeros((rows, 1), np.uint8), one))
    sizes = sum((r.lengths for r in runs), np.zeros(rows, np.int64))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    out, at = np.empty(int(offsets[-1]), np.uint8), offsets[:-1].copy()
    for run in runs:
        run.put(out, at)
        at += run.lengths
    return pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.binary())


# ---------------------------------------------------------------- decoding


class Reader:
    """One position a row in the records of a batch; fields are taken from all of them in turn."""

    def __init__(self, records: pa.Array):
        some = pc.fill_null(records.cast(pa.large_binary()), b"")
        n = len(some)
        offsets = np.frombuffer(some.buffers()[1], np.int64)[some.offset : some.offset + n + 1]
        data = some.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.raw = np.concatenate((raw, np.zeros(16, np.uint8)))  # reads past the end are found out below
        self.at, self.end = offsets[:-1].copy(), offsets[1:]
        self.there = pc.is_valid(records).to_numpy(zero_copy_only=False)

    def _forward(self, rows: np.ndarray, by: np.ndarray | int) -> None:
        self.at[rows] += by
        if (self.at[rows] > self.end[rows]).any():
            raise Damaged("truncated value")

    def varint(self, rows: np.ndarray) -> np.ndarray:
        value, live, shift = np.zeros(len(rows), np.uint64), np.arange(len(rows)), 0
        while len(live):
            if shift > 63:
                raise Damaged("number longer than 64 bits")
            byte = self.raw[self.at[rows[live]]]
            value[live] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
            self._forward(rows[live], 1)
            live, shift = live[byte >= 0x80], shift + 7
        return (value >> np.uint64(1)).view(np.int64) ^ -(value & np.uint64(1)).view(np.int64)

    def branch(self) -> np.ndarray:
        """Rows whose next field is not null."""
        rows = np.flatnonzero(self.there)
        index = self.varint(rows)
        if ((index != 0) & (index != 1)).any():
            raise OtherBranch("a branch beyond null and the plain value")
        return rows[index == 1]

    def fixed(self, rows: np.ndarray, size: int) -> np.ndarray:
        found = self.raw[np.minimum(self.at[rows][:, None] + np.arange(size), len(self.raw) - 1)]
        self._forward(rows, size)
        return found

    def ragged(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, bytes of all rows) of length-prefixed values."""
        lengths = self.varint(rows)
        if (lengths < 0).any():
            raise Damaged("negative length")
        starts = self.at[rows].copy()
        self._forward(rows, lengths)
        heads = np.cumsum(lengths) - lengths
        return lengths, self.raw[np.repeat(starts - heads, lengths) + np.arange(int(lengths.sum()))]

    def finish(self) -> None:
        if (self.at[self.there] != self.end[self.there]).any():
            raise Damaged("bytes after the value")


def _field(reader: Reader, kind: str, rows: np.ndarray, n: int, to: pa.DataType) -> pa.Array:
    gone = np.ones(n, bool)
    gone[rows] = False

    def spread(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n, values.dtype)
        out[rows] = values
        return out

    if kind in ("int", "long"):
        return pa.array(spread(reader.varint(rows)), mask=gone).cast(to)
    if kind == "boolean":
        return pa.array(spread(reader.fixed(rows, 1)[:, 0] != 0), mask=gone)
    if kind in ("float", "double"):
        size = 4 if kind == "float" else 8
        values = np.ascontiguousarray(reader.fixed(rows, size)).view(f"<f{size}")[:, 0] if len(rows) else np.zeros(0, f"<f{size}")
        return pa.array(spread(values), mask=gone).cast(to)
    if kind in ("bytes", "string"):
        lengths, data = reader.ragged(rows)
        offsets = np.concatenate(([0], np.cumsum(spread(lengths))))
        valid = pa.py_buffer(np.packbits(~gone, bitorder="little"))
        made = pa.Array.from_buffers(pa.large_binary(), n, [valid, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        return made.cast(pa.large_string()).cast(to) if kind == "string" else made.cast(to)
    parts = {f: reader.varint(rows) for f in NAMED[kind]}
    month = ((parts["year"] - 1970) * 12 + parts["month"] - 1).astype("datetime64[M]")
    days = month.astype("datetime64[D]").astype(np.int64) + parts["day"] - 1
    if kind == "Date":
        return pa.array(spread(days.astype(np.int32)), mask=gone).cast(pa.date32()).cast(to)
    micros = ((parts["hour"] * 60 + parts["minute"]) * 60 + parts["second"] - parts.get("zoneOffset", 0)) * 1_000_000 + parts["micro"]
    whole = pa.array(spread(days * DAY_MICROS + micros), mask=gone).cast(pa.timestamp("us"))
    return whole.cast(pa.int64()).cast(to) if pa.types.is_timestamp(to) else whole.cast(to)


def decode(records: pa.Array, kinds: Sequence[str], types: Sequence[pa.DataType]) -> list[pa.Array]:
    """Columns of the records' fields; null records are null in all of them."""
    reader, n = Reader(records), len(records)
    out = [_field(reader, kind, reader.branch(), n, to) for kind, to in zip(kinds, types)]
    reader.finish()
    return out


def flat_kinds(schema: dict[str, Any]) -> list[str] | None:
    """Kind of every field of a record of nullable plain values, dates or timestamps; None for any other."""
    plain = ("boolean", "float", "double", "int", "long", "bytes", "string", "Date", "DateTime", "DateTimeTZ")
    kinds = []
    for field in schema["fields"]:
        union = field["type"]
        if not isinstance(union, list) or union[0] != "null":
            return None
        name = union[1] if isinstance(union[1], str) else union[1]["name"]
        kind = name.rpartition(".")[2]
        if kind not in plain:
            return None
        kinds.append(kind)
    return kinds
