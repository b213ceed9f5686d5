"""Binary record encoding: zig-zag varints, little-endian floats, length-prefixed bytes, union indexes.

:func:`encode_table` and :func:`decode_rows` work on whole Arrow batches (see :mod:`.columnar`).
:func:`encode_rows` gives the same bytes value by value and also takes infinite dates;
:func:`decode_rows` goes that way for batches that hold some, or bytes that are damaged.
"""

from __future__ import annotations

import datetime
import decimal
import json
import struct
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import columnar
from .wire import SPECIAL, WITH_SPECIAL, row_schema, wire_kind


class TrailingBytes(ValueError):
    pass


# ---------------------------------------------------------------- plain values


def encode_long(value: int) -> bytes:
    if not -(1 << 63) <= value < 1 << 63:
        raise OverflowError(f"{value} does not fit 64 bits")
    rest = ((value << 1) ^ (value >> 63)) & (1 << 64) - 1
    out = bytearray()
    while rest > 0x7F:
        out.append(rest & 0x7F | 0x80)
        rest >>= 7
    out.append(rest)
    return bytes(out)


def decode_long(data: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        if at >= len(data):
            raise ValueError("truncated number")
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            break
        if shift > 63:
            raise ValueError("number longer than 64 bits")
    return (value >> 1) ^ -(value & 1), at


def _bytes(raw: bytes) -> bytes:
    return encode_long(len(raw)) + raw


def encode(schema: Any, value: Any, names: dict[str, Any] | None = None) -> bytes:
    """Encode ``value`` by a schema of records, enums, arrays, unions and primitives.

    In a union the branch is null for None, an enum for a str that is one of its
    symbols, else the first branch that is neither; a (index, value) pair wrapped in
    :class:`Branch` chooses explicitly.
    """
    names = {} if names is None else names
    if isinstance(schema, str) and schema in names:
        schema = names[schema]
    if isinstance(schema, list):
        _learn_all(schema, names)
        if isinstance(value, Branch):
            index, value = value
        else:
            index = _branch(schema, value, names)
        return encode_long(index) + encode(schema[index], value, names)
    kind = schema if isinstance(schema, str) else schema["type"]
    if kind == "null":
        return b""
    if kind == "boolean":
        return b"\x01" if value else b"\x00"
    if kind in ("int", "long"):
        return encode_long(int(value))
    if kind == "float":
        return struct.pack("<f", value)
    if kind == "double":
        return struct.pack("<d", float(value))
    if kind == "bytes":
        return _bytes(bytes(value))
    if kind == "string":
        return _bytes(str(value).encode("utf-8"))
    _learn(schema, names)
    if kind == "enum":
        return encode_long(schema["symbols"].index(value))
    if kind == "array":
        body = b"".join(encode(schema["items"], v, names) for v in value)
        return (encode_long(len(value)) + body if value else b"") + b"\x00"
    if kind == "record":
        return b"".join(encode(f["type"], value.get(f["name"]), names) for f in schema["fields"])
    raise ValueError(f"unknown type {kind!r}")


class Branch(tuple):
    """An explicit (index, value) of a union."""


def _learn(schema: dict[str, Any], names: dict[str, Any]) -> None:
    if "name" in schema:
        names[f"{schema.get('namespace', '')}.{schema['name']}".lstrip(".")] = schema


def _learn_all(union: list[Any], names: dict[str, Any]) -> None:
    """Names that a branch defines are needed later even where the branch is not taken."""
    for s in union:
        if isinstance(s, dict):
            _learn(s, names)


def _branch(schema: list[Any], value: Any, names: dict[str, Any]) -> int:
    kinds = []
    for s in schema:
        s = names.get(s, s) if isinstance(s, str) else s
        kinds.append((s if isinstance(s, str) else s["type"], s))
    for index, (kind, s) in enumerate(kinds):
        if value is None and kind == "null":
            return index
        if kind == "enum" and isinstance(value, str) and value in s["symbols"]:
            return index
    for index, (kind, s) in enumerate(kinds):
        if kind not in ("null", "enum") and value is not None:
            return index
    raise ValueError(f"no branch of {schema} for {value!r}")


def decode(schema: Any, data: bytes, at: int = 0, names: dict[str, Any] | None = None) -> tuple[Any, int]:
    """(value, position after it); records become dicts."""
    names = {} if names is None else names
    if isinstance(schema, str) and schema in names:
        schema = names[schema]
    if isinstance(schema, list):
        index, at = decode_long(data, at)
        if not 0 <= index < len(schema):
            raise ValueError(f"union index {index} out of range")
        _learn_all(schema, names)
        return decode(schema[index], data, at, names)
    kind = schema if isinstance(schema, str) else schema["type"]
    if kind == "null":
        return None, at
    if kind == "boolean":
        return _take(data, at, 1) != b"\x00", at + 1
    if kind in ("int", "long"):
        return decode_long(data, at)
    if kind == "float":
        return struct.unpack("<f", _take(data, at, 4))[0], at + 4
    if kind == "double":
        return struct.unpack("<d", _take(data, at, 8))[0], at + 8
    if kind in ("bytes", "string"):
        size, at = decode_long(data, at)
        if size < 0:
            raise ValueError("negative length")
        raw = _take(data, at, size)
        return (raw if kind == "bytes" else raw.decode("utf-8")), at + size
    _learn(schema, names)
    if kind == "enum":
        index, at = decode_long(data, at)
        return schema["symbols"][index], at
    if kind == "array":
        out: list[Any] = []
        while True:
            count, at = decode_long(data, at)
            if count == 0:
                return out, at
            if count < 0:  # a block that also states its size
                _, at = decode_long(data, at)
                count = -count
            for _ in range(count):
                value, at = decode(schema["items"], data, at, names)
                out.append(value)
    if kind == "record":
        record = {}
        for f in schema["fields"]:
            record[f["name"]], at = decode(f["type"], data, at, names)
        return record, at
    raise ValueError(f"unknown type {kind!r}")


def _take(data: bytes, at: int, size: int) -> bytes:
    if at + size > len(data):
        raise ValueError("truncated value")
    return data[at : at + size]


def decode_whole(schema: Any, data: bytes) -> Any:
    """Decode and insist that nothing is left over."""
    value, at = decode(schema, data)
    if at != len(data):
        raise TrailingBytes(f"{len(data) - at} bytes after the value")
    return value


# ---------------------------------------------------------------- frames


def encode_frame(messages: list[tuple[int, dict[str, Any]]]) -> bytes:
    """A frame from (tag, fields) messages."""
    from .wire import frame_schema

    return encode(frame_schema(), {"msg": [Branch(m) for m in messages]})


def decode_frame(data: bytes) -> list[tuple[int, dict[str, Any]]]:
    """(tag, fields) of each message of a frame; trailing bytes are an error."""
    from .wire import frame_schema

    schema = frame_schema()
    messages = schema["fields"][0]["type"]["items"]
    out, at = [], 0
    while True:
        count, at = decode_long(data, at)
        if count == 0:
            break
        if count < 0:
            _, at = decode_long(data, at)
            count = -count
        for _ in range(count):
            tag, at = decode_long(data, at)
            if not 0 <= tag < len(messages):
                raise ValueError(f"message tag {tag} out of range")
            value, at = decode(messages[tag], data, at)
            out.append((tag, value))
    if at != len(data):
        raise TrailingBytes(f"{len(data) - at} bytes after the frame")
    return out


# ---------------------------------------------------------------- SQL columns


def varint_column(value: Column, most: int = 10) -> Column:
    """Zig-zag varint of an integer column, from shifts and byte strings.

    ``most`` is the number of bytes that the largest value needs; it keeps generated code short.
    """
    x = value.cast("long")
    zig = F.shiftleft(x, 1).bitwiseXOR(F.shiftright(x, 63))
    out = []
    for k in range(most):
        rest = F.shiftrightunsigned(zig, 7 * k) if k else zig
        chunk = rest.bitwiseAND(F.lit(0x7F))
        if k < most - 1:
            chunk = F.when(F.shiftrightunsigned(zig, 7 * (k + 1)) != 0, chunk + 128).otherwise(chunk)
        byte = F.lpad(F.hex(chunk), 2, "0")
        out.append(byte if not k else F.when(rest != 0, byte).otherwise(F.lit("")))
    return F.unhex(F.concat(*out))


# ---------------------------------------------------------------- Arrow stage


def wire_value(value: Any, kind: str) -> Any:
    """A Python value as the encoder takes it."""
    if value is None:
        return None
    if kind in WITH_SPECIAL and isinstance(value, str) and value in SPECIAL:
        return value
    if kind == "Date":
        return {"year": value.year, "month": value.month, "day": value.day}
    if kind in ("DateTime", "DateTimeTZ"):
        out = {k: getattr(value, k) for k in ("year", "month", "day", "hour", "minute", "second")}
        out["micro"] = value.microsecond
        if kind == "DateTimeTZ":
            offset = value.utcoffset() if isinstance(value, datetime.datetime) else None
            out["zoneOffset"] = int(offset.total_seconds()) if offset else 0
        return out
    if kind == "double" and isinstance(value, decimal.Decimal):
        return float(value)
    return value


def encode_rows(
    df: DataFrame, table: str, columns: list[str], out: str = "value", namespace: str = "public",
    decimals: str = "double", keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns of ``df`` and the encoded record of ``columns`` in column ``out``."""
    part = T.StructType([df.schema[c] for c in columns])
    schema = row_schema(table, part, namespace, decimals)
    kinds = [wire_kind(f.dataType, decimals) for f in part.fields]
    names = [f["name"] for f in schema["fields"]]
    keep = [] if keep is None else keep
    text = [c for c, k in zip(columns, kinds) if k == "string"]
    source = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       *[(F.col(f"`{c}`").cast("string") if c in text else F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    blob = json.dumps(schema)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = json.loads(blob)
        for batch in batches:
            cols = [batch.column(f"c{i}").to_pylist() for i in range(len(columns))]
            rows = zip(*cols) if cols else ((),) * batch.num_rows
            data = [encode(made, {n: wire_value(v, k) for n, v, k in zip(names, row, kinds)}) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f"k{i}") for i in range(len(keep))], pa.array(data, pa.binary())], [*keep, out]
            )

    result = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.BinaryType())])
    return source.mapInArrow(stage, result)


def encode_table(
    df: DataFrame, table: str, columns: list[str] | None = None, out: str = "value", namespace: str = "public",
    decimals: str = "double", keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns of ``df`` and the encoded record of ``columns`` (all if None) in column ``out``."""
    columns = df.columns if columns is None else columns
    keep = [] if keep is None else keep
    kinds = [wire_kind(df.schema[c].dataType, decimals) for c in columns]
    # Text and wall-clock times are made by the engine; instants are sent in the session's zone.
    casts = {"string": "string", "DateTimeTZ": "timestamp_ntz", "double": "double"}
    fields = [F.col(f"`{c}`").cast(casts[k]) if k in casts else F.col(f"`{c}`") for c, k in zip(columns, kinds)]
    source = df.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], *[f.alias(f"c{i}") for i, f in enumerate(fields)],
        *([] if keep or columns else [F.lit(0).alias("none")]),
    )

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = columnar.encode([batch.column(f"c{i}") for i in range(len(kinds))], kinds, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(f"k{i}") for i in range(len(keep))], made], [*keep, out])

    result = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.BinaryType())])
    return source.mapInArrow(stage, result)


def decode_rows(df: DataFrame, schema: dict[str, Any], result: T.StructType, column: str = "value") -> DataFrame:
    """Decode a binary column into ``result`` (named types as structs or dates); trailing bytes fail."""
    blob = json.dumps(schema)
    fields = [(f["name"], r) for f, r in zip(schema["fields"], result.fields)]

    def back(value: Any, dtype: T.DataType) -> Any:
        if isinstance(value, dict) and isinstance(dtype, T.DateType):
            return datetime.date(value["year"], value["month"], value["day"])
        if isinstance(value, dict) and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            clock = datetime.datetime(*(value[k] for k in ("year", "month", "day", "hour", "minute", "second", "micro")))
            if isinstance(dtype, T.TimestampType):
                zone = datetime.timezone(datetime.timedelta(seconds=value.get("zoneOffset", 0)))
                return clock.replace(tzinfo=zone)
            return clock
        return value

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        made, arrow = json.loads(blob), to_arrow_schema(result)
        kinds = columnar.flat_kinds(made)
        for batch in batches:
            if kinds is not None:
                try:
                    cols = columnar.decode(batch.column(0), kinds, [f.type for f in arrow])
                    yield pa.RecordBatch.from_arrays(cols, schema=arrow)
                    continue
                except (columnar.OtherBranch, columnar.Damaged):
                    pass  # value by value: infinite dates, or the message that says which value is damaged
            rows = [None if v is None else decode_whole(made, v) for v in batch.column(0).to_pylist()]
            cols = [
                pa.array([None if r is None else back(r[n], f.dataType) for r in rows], arrow.field(i).type)
                for i, (n, f) in enumerate(fields)
            ]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.select(column).mapInArrow(stage, result)


def schema_prefix(schema_id: int | Column, payload: Column) -> Column:
    """Byte 0, the id as four big-endian bytes, then the payload; null stays null."""
    sid = F.lit(schema_id) if isinstance(schema_id, int) else schema_id
    return F.concat(F.lit(b"\x00"), F.unhex(F.right(F.lpad(F.hex(sid.cast("long")), 16, "0"), F.lit(8))), payload)
