"""Record schemas, the binary codec (both encoders), JSON, registries."""

import datetime
import decimal
import http.server
import json
import threading

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import avro, wire
from tideline.functions.tagged_json import json_column
from tideline.registry import FileRegistry, HttpRegistry, MemoryRegistry, RegistryError

ALL = T.StructType([
    T.StructField("b", T.BooleanType()), T.StructField("f", T.FloatType()), T.StructField("d", T.DoubleType()), T.StructField("s", T.ShortType()),
    T.StructField("i", T.IntegerType()), T.StructField("l", T.LongType()), T.StructField("n", T.DecimalType(10, 2)), T.StructField("da", T.DateType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("tz", T.TimestampType()), T.StructField("y", T.BinaryType()),
    T.StructField("t", T.StringType()), T.StructField("a", T.ArrayType(T.IntegerType())),
])
ROW = (
    True, 1.5, -2.25, 7, -42, 2**40, decimal.Decimal("42.50"), datetime.date(2014, 12, 27), datetime.datetime(2014, 12, 27, 17, 40, 15, 123456),
    datetime.datetime(2014, 12, 27, 16, 40, 15, 123456), b"\xbe\xef\x00\xca\xfe", "We can handle unicode: ☃", [1, 2],
)


def test_source_types():
    want = {
        "smallint": "int", "integer": "int", "bigint": "long", "real": "float", "double precision": "double", "numeric(10,2)": "double",
        "money": "long", "oid": "long", "boolean": "boolean", "bytea": "bytes", "date": "Date", "time": "long", "timetz": "TimeTZ",
        "timestamp": "DateTime", "timestamp(3) with time zone": "DateTimeTZ", "interval": "Interval", "text": "string", "character(24)": "string",
        "uuid": "string", "jsonb": "string", "integer[]": "string", "int4range": "string", "point": "string", "mood": "string",
    }
    assert {k: wire.wire_kind_of_source(k) for k in want} == want


def test_row_schema():
    made = wire.row_schema("crêpes", ALL, "my.app")
    assert made["name"] == "cr_c3__aa_pes" and made["namespace"] == f"{wire.ROOT}.my.app"
    assert [f["name"] for f in made["fields"]] == ALL.names
    assert all(f["type"][0] == "null" for f in made["fields"])
    kinds = {f["name"]: f["type"][1] for f in made["fields"]}
    assert kinds["n"] == "double" and kinds["s"] == "int" and kinds["a"] == "string"
    assert kinds["da"]["name"] == "Date"
    text = wire.schema_json(made)
    assert text.count('"symbols"') == 1  # defined once, named afterwards
    assert wire.row_schema("t", ALL, decimals="exact")["fields"][6]["type"][1] == "string"


def test_dummy_and_keys():
    empty = wire.row_schema("zero", T.StructType([]))
    assert [(f["name"], f["type"]) for f in empty["fields"]] == [("dummy", ["null", "boolean"])]
    key = wire.key_schema("things_pkey", ALL, ["l", "i"])
    assert key["name"] == "things_pkey" and [f["name"] for f in key["fields"]] == ["l", "i"]
    with pytest.raises(wire.UnkeyedTable):
        wire.key_schema("x", ALL, [])
    assert len(wire.frame_schema()["fields"][0]["type"]["items"]) == 6


@given(st.integers(-(2**63), 2**63 - 1))
def test_varint(x):
    data = avro.encode_long(x)
    assert avro.decode_long(data, 0) == (x, len(data)) and len(data) <= 10


def test_varint_known():
    assert [avro.encode_long(x).hex() for x in (0, -1, 1, -64, 64, 300)] == ["00", "01", "02", "7f", "8001", "d804"]
    with pytest.raises(OverflowError):
        avro.encode_long(2**63)


VALUE = st.fixed_dictionaries({
    "b": st.none() | st.booleans(), "l": st.none() | st.integers(-(2**63), 2**63 - 1), "d": st.none() | st.floats(allow_nan=False),
    "t": st.none() | st.text(), "y": st.none() | st.binary(),
})


@given(VALUE)
def test_record_roundtrip(value):
    schema = wire.row_schema("t", T.StructType([ALL[c] for c in ("b", "l", "d", "t", "y")]))
    data = avro.encode(schema, value)
    assert avro.decode_whole(schema, data) == value
    with pytest.raises(avro.TrailingBytes):
        avro.decode_whole(schema, data + b"\x00")


def test_special_times():
    schema = wire.row_schema("t", T.StructType([T.StructField(c, T.DateType()) for c in "azn"]))
    value = {"a": "POS_INFINITY", "z": "NEG_INFINITY", "n": {"year": 2014, "month": 12, "day": 27}}
    data = avro.encode(schema, value)
    assert data[:4].hex() == "04000402" and avro.decode_whole(schema, data) == value


FRAMES = [
    [],
    [(0, {"xid": 7}), (1, {"xid": 7, "lsn": 2**40})],
    [(2, {"relid": 1, "keySchema": None, "rowSchema": "{}"}), (3, {"relid": 1, "key": None, "newRow": b"r"})],
    [(5, {"relid": 1, "key": b"k", "oldRow": b"o"}), (3, {"relid": 1, "key": b"l", "newRow": b"n"})],
    [(4, {"relid": 1, "key": b"k", "oldRow": None, "newRow": b""})],
]


@pytest.mark.parametrize("messages", FRAMES)
def test_frames(messages):
    data = avro.encode_frame(messages)
    assert avro.decode_frame(data) == messages
    with pytest.raises(avro.TrailingBytes):
        avro.decode_frame(data + b"\x00")
    if messages:
        with pytest.raises(ValueError):
            avro.decode_frame(data[:-2])


def test_both_encoders_agree(spark):
    cols = ["b", "s", "i", "l", "da", "ts", "tz", "y", "t", "a"]
    part = T.StructType([ALL[c] for c in cols])
    rows = [tuple(v for v, f in zip(ROW, ALL) if f.name in cols), (None,) * len(cols), (False, -1, 0, -(2**63), *ROW[7:10], b"", "", [])]
    df = spark.createDataFrame(rows, part)
    native = [bytes(r[0]) for r in avro.encode_table(df, "t").collect()]
    staged = [bytes(r["value"]) for r in avro.encode_rows(df, "t", cols).collect()]
    assert native == staged
    whole = spark.createDataFrame([ROW, (None,) * len(ROW), (False, float("-inf"), 0.1, *ROW[3:])], ALL)
    mixed = avro.encode_table(whole, "t", keep=["d", "t"]).collect()
    assert [bytes(r["value"]) for r in mixed] == [bytes(r["value"]) for r in avro.encode_rows(whole, "t", ALL.names).collect()]
    assert [r["d"] for r in mixed] == [-2.25, None, 0.1]
    schema = wire.row_schema("t", part)
    assert avro.decode_whole(schema, native[0])["ts"] == dict(year=2014, month=12, day=27, hour=17, minute=40, second=15, micro=123456)


def test_table_roundtrip(spark):
    part = T.StructType([f for f in ALL.fields if f.name not in ("n", "a", "tz")])
    rows = [tuple(v for v, f in zip(ROW, ALL) if f.name in part.names), (None,) * len(part)]
    df = spark.createDataFrame(rows, part)
    again = avro.decode_rows(avro.encode_table(df, "t"), wire.row_schema("t", part), part)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(
    st.none() | st.integers(-(2**63), 2**63 - 1), st.none() | st.text(max_size=200), st.none() | st.floats(allow_nan=False), st.none() | st.binary(max_size=9),
    st.none() | st.booleans(), st.none() | st.dates(), st.none() | st.datetimes(),
), max_size=12))
def test_columns_against_values(rows):
    """Whole batches give the bytes of the value-by-value encoder, and come back."""
    import pyarrow as pa

    from tideline.functions import columnar

    types = [pa.int64(), pa.string(), pa.float64(), pa.binary(), pa.bool_(), pa.date32(), pa.timestamp("us")]
    kinds = ["long", "string", "double", "bytes", "boolean", "Date", "DateTime"]
    part = T.StructType.fromDDL("a long, b string, c double, d binary, e boolean, f date, g timestamp_ntz")
    schema = wire.row_schema("t", part)
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
    made = columnar.encode(columns, kinds, len(rows))
    assert made.to_pylist() == [avro.encode(schema, {n: avro.wire_value(v, k) for n, v, k in zip(part.names, r, kinds)}) for r in rows]
    assert columnar.flat_kinds(schema) == kinds
    sliced = pa.concat_arrays([pa.array([b"junk", None], pa.binary()), made]).slice(2)
    assert [c.to_pylist() for c in columnar.decode(sliced, kinds, types)] == [c.to_pylist() for c in columns]
    assert all(c.to_pylist() == [None] for c in columnar.decode(pa.array([None], pa.binary()), kinds, types))
    for k in range(len(rows)):
        with pytest.raises((columnar.Damaged, columnar.OtherBranch)):
            columnar.decode(pa.array([made[k].as_py()[:-1]], pa.binary()), kinds, types)
        with pytest.raises(columnar.Damaged):
            columnar.decode(pa.array([made[k].as_py() + b"\x00"], pa.binary()), kinds, types)


def test_decoding_falls_back_to_values(spark):
    """Infinite dates go value by value; damaged bytes fail with what is wrong."""
    part = T.StructType.fromDDL("i int, s string")
    schema = wire.row_schema("t", part)
    good = avro.encode(schema, {"i": 5, "s": "x"})
    frame = lambda rows: spark.createDataFrame([(r,) for r in rows], "value binary")
    assert [tuple(r) for r in avro.decode_rows(frame([good, None]), schema, part).collect()] == [(5, "x"), (None, None)]
    with pytest.raises(Exception, match="1 bytes after the value"):
        avro.decode_rows(frame([good, good + b"y"]), schema, part).collect()
    dated = T.StructType.fromDDL("d date")
    both = wire.row_schema("t", dated)
    rows = [avro.encode(both, {"d": "POS_INFINITY"}), avro.encode(both, {"d": {"year": 2014, "month": 12, "day": 27}})]
    text = T.StructType.fromDDL("d string")
    assert [r["d"] for r in avro.decode_rows(frame(rows[:1]), both, text).collect()] == ["POS_INFINITY"]


def test_json(spark):
    df = spark.createDataFrame([ROW, (None,) * len(ROW)], ALL)
    rows = [json.loads(r[0]) for r in df.select(json_column(df.schema, df.columns)).collect()]
    got = rows[0]
    assert got["i"] == {"int": -42} and got["l"] == {"long": 2**40} and got["n"] == {"double": 42.5}
    assert got["t"] == {"string": "We can handle unicode: ☃"}
    assert got["y"] == {"bytes": b"\xbe\xef\x00\xca\xfe".decode("latin-1")}
    assert got["da"] == {"tideline.datatypes.Date": {"year": 2014, "month": 12, "day": 27}}
    assert got["tz"]["tideline.datatypes.DateTimeTZ"]["zoneOffset"] == 0
    assert rows[1] == dict.fromkeys(ALL.names)
    assert spark.range(1).select(json_column(T.StructType([]), [])).first()[0] == '{"dummy":null}'


def test_prefix(spark):
    row = spark.range(1).select(F.hex(avro.schema_prefix(258, F.lit(b"\x01"))), avro.schema_prefix(1, F.lit(None).cast("binary"))).first()
    assert row[0] == "000000010201" and row[1] is None


def test_registries(tmp_path):
    memory = MemoryRegistry()
    assert memory.register_table("t", '"k"', '"r"') == (1, 2)
    assert memory.register_table("t", '"k"', '"r2"') == (1, 3) and memory.register_table("u", None, '"r"') == (None, 2)
    path = str(tmp_path / "sub" / "registry.json")
    assert FileRegistry(path).register("t-value", "{}") == 1
    again = FileRegistry(path)
    assert again.register("t-value", "{}") == 1 and again.register("t-value", "[]") == 2


class Handler(http.server.BaseHTTPRequestHandler):
    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.server.seen.append((self.path, body))
        answer = json.dumps({"id": 5} if "fail" not in self.path else {"error": 1}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(answer)

    def log_message(self, *args):
        pass


def test_http_registry():
    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    server.seen = []
    threading.Thread(target=server.serve_forever, daemon=True).start()
    registry = HttpRegistry(f"http://127.0.0.1:{server.server_port}/")
    assert registry.register("t-key", "{}") == 5
    assert server.seen == [("/subjects/t-key/versions", {"schema": "{}"})]
    with pytest.raises(RegistryError):
        registry.register("fail-key", "{}")
    server.shutdown()
    with pytest.raises(RegistryError):
        HttpRegistry("http://127.0.0.1:9", 1).register("t", "{}")
