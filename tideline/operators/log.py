"""The change log: canonical form, key-change splitting, schemas in force, frames.

A change log has ``lsn, seq, xid, kind, relid`` and, for rows, the structs ``key``, ``old``
and ``new``. ``(lsn, seq)`` orders it; ``kind`` is begin, commit, schema, insert, update
or delete.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_KINDS = ("insert", "update", "delete")


def key_struct(columns: list[str]) -> Column:
    """Key columns in index order; an unkeyed table has a null key."""
    return F.struct(*columns) if columns else F.lit(None)


def position() -> Column:
    return F.struct("lsn", "seq")


def check_rows(log: DataFrame) -> Column:
    """Fault of a row event that lacks what its kind needs, or null."""
    return (
        F.when(~F.col("kind").isin(*ROW_KINDS), F.format_string("unknown change kind %s", F.col("kind")))
        .when(F.col("kind").isin("insert", "update") & F.col("new").isNull(), F.format_string("%s without a new row", F.col("kind")))
    )


def _same_key(a: Column, b: Column, dtype: T.DataType) -> Column:
    """Equal as encoded: nulls are alike, and floating-point numbers are told apart by their text, so -0.0 is not 0.0."""
    if isinstance(dtype, T.StructType):
        same = a.isNull() == b.isNull()
        for f in dtype.fields:
            same = same & _same_key(a.getField(f.name), b.getField(f.name), f.dataType)
        return same
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return a.cast("string").eqNullSafe(b.cast("string"))
    return a.eqNullSafe(b)


def split_key_changes(log: DataFrame, old_key: Column) -> DataFrame:
    """Replace an update that changes the key by delete(old key), insert(new key), in that order.

    ``old_key`` is null where the old row is not known; the update then stays whole.
    Keys are compared as their encoded bytes would be. ``seq`` is doubled to make room: the delete gets
    2 seq, what follows it 2 seq + 1, and unsplit events 2 seq.
    """
    moved = (F.col("kind") == "update") & old_key.isNotNull() & ~_same_key(old_key, F.col("key"), log.schema["key"].dataType)
    delete = F.struct(F.lit(0).alias("step"), F.lit("delete").alias("kind"), old_key.alias("key"))
    insert = F.struct(F.lit(1).alias("step"), F.lit("insert").alias("kind"), F.col("key").alias("key"))
    same = F.struct(F.lit(0).alias("step"), F.col("kind").alias("kind"), F.col("key").alias("key"))
    events = F.explode(F.when(moved, F.array(delete, insert)).otherwise(F.array(same)))
    rest = [c for c in log.columns if c not in ("seq", "kind", "key", "new")]
    out = log.select(*rest, F.col("seq").alias("__seq"), F.col("new").alias("__new"), events.alias("__e"))
    return out.select(
        *rest,
        (F.col("__seq") * 2 + F.col("__e.step")).alias("seq"),
        F.col("__e.kind").alias("kind"),
        F.col("__e.key").alias("key"),
        F.when(F.col("__e.kind") != "delete", F.col("__new")).alias("new"),
    )


MAX_BROADCAST_SCHEMAS = 1000
MAX_LITERAL_SCHEMAS = 64


def version_in_force(versions: list[tuple[int | None, int, int]]) -> Column:
    """Of schema events ``(relid, lsn, seq)`` that the driver has, the number of the row's latest at or before its position, or null.

    A literal of the plan: nothing is counted, joined or moved. For few events, as each is a part of the expression.
    """
    tables: dict[int, list] = {}
    for k, (relid, lsn, seq) in enumerate(versions):
        if relid is not None:
            tables.setdefault(relid, []).append((lsn, seq, k))
    out = F.lit(None).cast("int")
    for relid, history in tables.items():
        latest = F.lit(None).cast("int")
        for lsn, seq, k in sorted(history):
            reached = (F.col("lsn") > lsn) | ((F.col("lsn") == lsn) & (F.col("seq") >= seq))
            latest = F.when(reached, F.lit(k)).otherwise(latest)
        out = F.when(F.col("relid") == relid, latest).otherwise(out)
    return out


def schema_in_force(
    rows: DataFrame, schemas: DataFrame, version: str = "schema_version", max_broadcast: int = MAX_BROADCAST_SCHEMAS
) -> DataFrame:
    """Each row event with the latest schema of its table at or before its position (null if none).

    Schema events are few. Up to ``max_broadcast`` of them (counted first) become one sorted list a
    table, broadcast to the rows, which are then neither moved nor sorted: a table with most of
    the traffic is no hot task. More of them are merged into the rows' order by a window per table.
    """
    if schemas.limit(max_broadcast + 1).count() <= max_broadcast:
        history = F.sort_array(F.collect_list(F.struct("lsn", "seq", F.col(version).alias("v"))))
        lists = F.broadcast(schemas.groupBy(F.col("relid").alias("__relid")).agg(history.alias("__history")))
        joined = rows.join(lists, rows["relid"] == F.col("__relid"), "left")
        at = F.struct(F.col("lsn"), F.col("seq"))
        before = F.filter("__history", lambda s: F.struct(s["lsn"], s["seq"]) <= at)
        latest = F.try_element_at(before, F.lit(-1))["v"]
        return joined.withColumn(version, latest).drop("__relid", "__history")
    marks = schemas.filter(F.col("relid").isNotNull()).select("relid", "lsn", "seq", F.struct(F.col(version).alias("v")).alias("__mark"))
    both = rows.withColumn("__row", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    # A schema event goes before a row at its own position.
    order = Window.partitionBy("relid").orderBy("lsn", "seq", F.col("__row").asc_nulls_first())
    filled = both.withColumn("__mark", F.last("__mark", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return filled.filter("__row").withColumn(version, F.col("__mark.v")).drop("__row", "__mark")


def schema_changes(schemas: DataFrame, text: str = "schema_version") -> DataFrame:
    """Schema events with ``change``: new, changed or unchanged against the table's previous one."""
    order = Window.partitionBy("relid").orderBy("lsn", "seq")
    before = F.lag(F.struct(F.col(text))).over(order)
    change = (
        F.when(before.isNull(), F.lit("new"))
        .when(before.getField(text).eqNullSafe(F.col(text)), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return schemas.withColumn("change", change)


FRAME_TYPE = (
    T.StructType()
    .add("tag", "integer")
    .add("xid", "long")
    .add("lsn", "long")
    .add("relid", "long")
    .add("key_schema", "string")
    .add("row_schema", "string")
    .add("key", "binary")
    .add("old_row", "binary")
    .add("new_row", "binary")
)


def explode_frames(
    frames: DataFrame, column: str = "frame", keep: tuple[str, ...] = ("lsn",), faults: bool = False
) -> DataFrame:
    """One row per message of each binary frame: ``keep``, ``seq`` and the message's fields.

    Frames are decoded in Arrow batches. An empty frame has no rows. A bad frame, such as one with
    trailing bytes, fails; with ``faults`` it is one row without a kind, and a column ``fault`` says why.
    ``kind`` is the change-log kind of the tag.
    """
    fields = [*[T.StructField(f"frame_{c}", frames.schema[c].dataType) for c in keep], T.StructField("seq", T.IntegerType()), *FRAME_TYPE.fields]
    fields += [T.StructField("fault", T.StringType())] if faults else []
    result = T.StructType(fields)
    names = {"keySchema": "key_schema", "rowSchema": "row_schema", "oldRow": "old_row", "newRow": "new_row"}

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        from ..functions.avro import decode_frame

        arrow = to_arrow_schema(result)
        for batch in batches:
            rows = []
            kept = [batch.column(c).to_pylist() for c in keep]
            for i, frame in enumerate(batch.column(column).to_pylist()):
                at = {f"frame_{c}": kept[k][i] for k, c in enumerate(keep)}
                try:
                    decoded = decode_frame(frame) if frame is not None else ()
                except ValueError as e:
                    if not faults:
                        raise
                    rows.append(at | {"seq": 0, "fault": str(e)})
                    continue
                for seq, (tag, message) in enumerate(decoded):
                    row = dict(at)
                    row |= {"seq": seq, "tag": tag} | {names.get(k, k): v for k, v in message.items()}
                    rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in arrow], schema=arrow)

    out = frames.select(*keep, column).mapInArrow(stage, result)
    kinds = F.array(*[F.lit(k) for k in ("begin", "commit", "schema", "insert", "update", "delete")])
    return out.withColumn("kind", F.when(F.col("tag").isNotNull(), F.get(kinds, F.col("tag"))))
