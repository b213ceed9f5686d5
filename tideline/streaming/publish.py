"""From change events to messages of topics, inside a stream: typed logs of one table, and frames of many.

A *typed* log has the structs ``key``, ``old_key`` and ``new`` of one table. An *event* log is what
:func:`tideline.operators.log.explode_frames` gives: encoded keys and rows, and schema events that say
which table an event's ``relid`` is and how its rows are encoded, from that position on.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from json.encoder import encode_basestring
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columnar
from ..functions.avro import decode_whole, encode_table, schema_prefix
from ..functions.naming import topic_name
from ..functions.tagged_json import branch_label, json_column
from ..functions.wire import ROOT
from ..operators.log import MAX_LITERAL_SCHEMAS, check_rows, schema_in_force, split_key_changes, version_in_force
from ..operators.messages import to_messages
from ..policy import ErrorPolicy, PublishError, apply_policy, handle, or_fail
from ..registry import Registry
from ..sources.catalog import Table

#: Schema events that one micro-batch may hold; they are taken to the driver.
MAX_SCHEMA_EVENTS = 10_000


def typed_messages(
    log: DataFrame, table: Table, topic: str, form: str = "json", ids: tuple[int | None, int | None] = (None, None),
    policy: ErrorPolicy = ErrorPolicy.EXIT, decimals: str = "double",
) -> DataFrame:
    """Messages of a typed log, batch or streaming: faults, key changes split, key and row encoded.

    ``ids`` are the registered ids of the key's and the row's schema.
    """
    fine, _ = apply_policy(log, check_rows(log), policy)
    if table.key and "old_key" in log.columns:
        fine = split_key_changes(fine, F.col("old_key"))
    row = log.schema["new"].dataType
    keys = T.StructType([row[c] for c in table.key])
    position = ["kind", "xid", "lsn", "seq"]
    # Key columns come from the key, not the row: a delete has no row.
    flat = fine.select(
        *position, *[F.col(f"key.`{c}`").alias(f"__k{i}") for i, c in enumerate(table.key)],
        *[F.col(f"new.`{f.name}`").alias(f.name) for f in row.fields],
    )
    if form == "json":
        value = json_column(row, row.names, decimals)
        flat = flat.withColumn("__value", value)
        named = flat.select(*position, "__value", *[F.col(f"__k{i}").alias(c) for i, c in enumerate(table.key)])
        key = json_column(keys, table.key, decimals) if table.key else F.lit(None).cast("string")
        return to_messages(named.withColumn("__key", key), F.col("__key"), F.col("__value"), F.lit(topic))
    kept = [*position, *[f"__k{i}" for i in range(len(table.key))]]
    rows = encode_table(flat, table.name, row.names, "__value", table.namespace, decimals, keep=kept)
    if table.key:
        named = rows.select(*position, "__value", *[F.col(f"__k{i}").alias(c) for i, c in enumerate(table.key)])
        rows = encode_table(named, table.key_index, table.key, "__key", table.namespace, decimals, keep=[*position, "__value"])
    else:
        rows = rows.withColumn("__key", F.lit(None).cast("binary"))
    key_id, row_id = ids
    key = schema_prefix(key_id, F.col("__key")) if key_id is not None else F.col("__key")
    value = schema_prefix(row_id, F.col("__value")) if row_id is not None else F.col("__value")
    return to_messages(rows, key, value, F.lit(topic))


# ---------------------------------------------------------------- events of many tables


@dataclass
class Relation:
    """What the last schema event said of a table, and how its messages are sent."""

    relid: int
    lsn: int
    seq: int
    topic: str | None
    key_schema: str | None
    row_schema: str
    key_id: int | None = None
    row_id: int | None = None
    error: str | None = None


RELATION = "relid long, lsn long, seq int, topic string, key_schema string, row_schema string, key_id int, row_id int, error string"


def topic_of(row_schema: str, prefix: str | None = None) -> str:
    """The topic of a table by its row schema; names in schemas are sanitised already."""
    made = json.loads(row_schema)
    namespace = made.get("namespace", "")
    namespace = namespace[len(ROOT) + 1 :] if namespace.startswith(f"{ROOT}.") else namespace
    return topic_name(made["name"], namespace or None, prefix)


@dataclass
class EventPublisher:
    """Messages of event logs, one micro-batch after another.

    Every schema event registers its schemas again and may rename the table's topic; rows go by the schema
    in force at their position, so a batch may hold rows of several versions. What is known of the
    tables is written under ``state`` before a batch's messages are, and read again at a restart. A
    table whose registration fails under the log policy is marked: its rows are dead letters until
    its next schema event. So are rows of tables that no schema event has named.
    """

    state: str
    form: str = "avro"
    registry: Registry | None = None
    prefix: str | None = None
    policy: ErrorPolicy = ErrorPolicy.EXIT
    known: dict[int, Relation] = field(default_factory=dict)
    loaded: bool = False
    #: Columns of the tables' last versions: most batches bring no other, and making them costs more than a small batch's rows.
    made: tuple = (None, None)
    #: Whether the last batch's messages lie in the tasks of their events.
    in_place: bool = False

    # ------------------------------------------------------------ tables

    def _path(self, batch_id: int) -> str:
        return f"{self.state}/batch={batch_id}"

    def _load(self, spark: SparkSession, batch_id: int) -> None:
        """The tables known before ``batch_id``: the newest state of an earlier batch."""
        numbers = [n for n in _folders(spark, self.state) if n < batch_id]
        rows = spark.read.schema(RELATION).parquet(self._path(max(numbers))).collect() if numbers else []
        self.known = {r["relid"]: Relation(**r.asDict()) for r in rows}
        self.loaded = True

    def _announce(self, row: Any) -> Relation:
        at = Relation(row["relid"], row["lsn"], row["seq"], None, row["key_schema"], row["row_schema"])
        try:
            at.topic = topic_of(row["row_schema"], self.prefix)
            if self.registry is not None:
                at.key_id, at.row_id = self.registry.register_table(at.topic, row["key_schema"], row["row_schema"])
        except Exception as e:  # noqa: BLE001  the policy decides about any fault of a table
            handle(e, self.policy, f"schema of table {row['relid']}")
            at.error = str(e)
        return at

    def relations(self, events: DataFrame, batch_id: int) -> list[Relation]:
        """All versions that rows of this batch can have, oldest first; the newest of each table is kept for the next."""
        spark = events.sparkSession
        if not self.loaded:
            self._load(spark, batch_id)
        marks = events.filter("kind = 'schema'").select("relid", "lsn", "seq", "key_schema", "row_schema")
        rows = marks.orderBy("lsn", "seq").limit(MAX_SCHEMA_EVENTS + 1).collect()
        if len(rows) > MAX_SCHEMA_EVENTS:
            raise PublishError(f"more than {MAX_SCHEMA_EVENTS} schema events in a batch; use smaller batches")
        versions = list(self.known.values())
        for row in rows:
            before = self.known.get(row["relid"])
            same = before is not None and before.error is None and (before.key_schema, before.row_schema) == (row["key_schema"], row["row_schema"])
            self.known[row["relid"]] = now = before if same else self._announce(row)
            versions.append(now)
        if rows or batch_id == 0:
            state = [tuple(vars(r).values()) for r in self.known.values()]
            spark.createDataFrame(state, RELATION).coalesce(1).write.mode("overwrite").parquet(self._path(batch_id))
        return versions

    # ------------------------------------------------------------ rows

    def messages(self, events: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame | None]:
        """(messages, dead letters with an ``error``) of a batch of events; None are dead under the exit policy."""
        versions = self.relations(events, batch_id)
        unique = {(v.relid, v.lsn, v.seq): v for v in versions}
        rows = events.filter("kind IN ('insert', 'update', 'delete')")
        numbered = list(unique.values())
        self.in_place = len(numbered) <= MAX_LITERAL_SCHEMAS
        if self.made[0] != numbered:
            fault = F.when(F.col("relation").isNull(), F.concat(F.lit("unknown table "), F.coalesce(F.col("relid").cast("string"), F.lit("null"))))
            if any(v.error is not None for v in numbered):
                fault = F.coalesce(fault, _of(numbered, "error"))
            number = version_in_force([(v.relid, v.lsn, v.seq) for v in numbered]) if self.in_place else None
            self.made = numbered, (number, fault, or_fail(fault))
        number, fault, sound = self.made[1]
        placed = rows.withColumn("relation", number) if self.in_place else _joined(rows, numbered)
        fine, dead = (placed.filter(sound), None) if self.policy is ErrorPolicy.EXIT else apply_policy(placed, fault, self.policy)
        if self.form == "json":
            return _as_json(fine, numbered), dead
        key, value = (_prefixed(_of(numbered, i, "int"), F.col(c)) for i, c in (("key_id", "key"), ("row_id", "new_row")))
        return to_messages(fine, key, value, _of(numbered, "topic")), dead


def _joined(rows: DataFrame, versions: list[Relation]) -> DataFrame:
    """Rows with the number of the ``relation`` in force at their position, where the versions are too many for a part of the plan."""
    marks = [(v.relid, v.lsn, v.seq, k) for k, v in enumerate(versions)]
    schemas = rows.sparkSession.createDataFrame(marks, "relid long, lsn long, seq int, relation int")
    return schema_in_force(rows, schemas, "relation")


def _of(versions: list[Relation], part: str, kind: str = "string") -> Column:
    """A part of the row's relation, by its number."""
    values = [F.lit(getattr(v, part)).cast(kind) for v in versions]
    return F.get(F.array(*values), F.col("relation")) if values else F.lit(None).cast(kind)


def _prefixed(schema_id: Column, payload: Column) -> Column:
    return F.when(schema_id.isNotNull(), schema_prefix(schema_id, payload)).otherwise(payload)


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete ``batch=N`` folders under a path of any file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    found = [s.getPath() for s in files.listStatus(at)]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return [int(n.removeprefix("batch=")) for p in done if (n := p.getName()).startswith("batch=")]


def _tagged(schema: Any, value: Any) -> Any:
    """A decoded value with the branch of each union named, as JSON messages have it."""
    if isinstance(schema, dict) and schema.get("type") == "record":
        return {f["name"]: _tagged(f["type"], value[f["name"]]) for f in schema["fields"]}
    if isinstance(schema, list):
        if value is None:
            return None
        kind = next(s for s in schema if s != "null")
        if isinstance(value, str) and not isinstance(kind, str):  # an infinite date
            return {branch_label("SpecialTime"): value}
        name = kind if isinstance(kind, str) else kind["name"]
        return {branch_label(name.rpartition(".")[2]): value.decode("latin-1") if isinstance(value, bytes) else value}
    return value.decode("latin-1") if isinstance(value, bytes) else value


#: JSON text of a plain value of each kind.
PLAIN = {
    "int": (pa.int32(), str), "long": (pa.int64(), str), "float": (pa.float32(), json.dumps), "double": (pa.float64(), json.dumps),
    "boolean": (pa.bool_(), json.dumps), "string": (pa.string(), encode_basestring), "bytes": (pa.binary(), lambda v: encode_basestring(v.decode("latin-1"))),
}


#: What a JSON string has to escape.
ESCAPED = r'["\\\x00-\x1f]'


def _plain_texts(kind: str, column: pa.Array) -> pa.Array:
    """JSON text of plain values of a kind; of whole numbers and of strings without escapes at once."""
    if kind in ("int", "long"):
        return column.cast(pa.string())
    if kind == "string" and not pc.any(pc.match_substring_regex(column, ESCAPED)).as_py():
        return pc.binary_join_element_wise('"', column, '"', "")
    text = PLAIN[kind][1]
    return pa.array([None if v is None else text(v) for v in column.to_pylist()], pa.string())


def _json_texts(schema: dict[str, Any], records: pa.Array) -> list[str | None]:
    return _json_array(schema, records).to_pylist()


def _json_array(schema: dict[str, Any], records: pa.Array) -> pa.Array:
    """Encoded records of one schema as JSON text, a column at a time where all values are plain."""
    kinds = columnar.flat_kinds(schema)
    if kinds and all(k in PLAIN for k in kinds):
        try:
            columns = columnar.decode(records, kinds, [PLAIN[k][0] for k in kinds])
        except (columnar.OtherBranch, columnar.Damaged):
            pass  # value by value: the message says which value is damaged
        else:
            parts = []
            for k, (field, kind, column) in enumerate(zip(schema["fields"], kinds, columns)):
                name = ("," if k else "{") + encode_basestring(field["name"])
                some = pc.binary_join_element_wise(f'{name}:{{"{branch_label(kind)}":', _plain_texts(kind, column), "}", "")
                parts.append(pc.fill_null(some, f"{name}:null"))
            return pc.if_else(pc.is_valid(records), pc.binary_join_element_wise(*parts, "}", ""), pa.scalar(None, pa.string()))
    made = [None if v is None else _tagged(schema, decode_whole(schema, v)) for v in records.to_pylist()]
    return pa.array([None if v is None else json.dumps(v, separators=(",", ":"), ensure_ascii=False) for v in made], pa.string())


def _as_json(rows: DataFrame, versions: list[Relation]) -> DataFrame:
    """The messages of rows, as :func:`to_messages` makes them: keys and rows decoded by their relation's schemas."""
    known = [(v.topic, *[text and json.loads(text) for text in (v.key_schema, v.row_schema)]) for v in versions]
    kept = ["xid", "lsn", "seq"]
    added = [T.StructField(c, T.StringType()) for c in ("topic", "key", "value")]
    result = T.StructType([*added, *[rows.schema[c] for c in kept]])

    def stage(batches):
        for batch in batches:
            at = batch.column("relation").to_numpy(zero_copy_only=False)
            parts, places = [], []
            for k in np.unique(at).tolist():
                topic, key, row = known[int(k)]
                places.append(np.flatnonzero(at == k))
                where = pa.array(places[-1])
                made = [pa.repeat(pa.scalar(topic, pa.string()), len(where))]
                made += [pa.nulls(len(where), pa.string()) if s is None else _json_array(s, batch.column(c).take(where)) for s, c in ((key, "key"), (row, "new_row"))]
                parts.append(made)
            if not parts:
                continue
            back = pa.array(np.argsort(np.concatenate(places)))
            topic, key, value = (pa.concat_arrays(columns).take(back) for columns in zip(*parts))
            delete = pc.equal(batch.column("kind"), "delete")
            made = [topic, key, pc.if_else(delete, pa.scalar(None, pa.string()), value), *[batch.column(c) for c in kept]]
            # A delete without a key says nothing to a reader of the topic.
            yield pa.RecordBatch.from_arrays(made, result.names).filter(pc.or_(pc.is_valid(key), pc.invert(delete)))

    return rows.select("kind", *kept, "relation", "key", "new_row").mapInArrow(stage, result)
