"""Helpers shared by the training-data operators.

Nothing here holds data on one machine: intermediate tables go to the shared
folder that the session names in ``spark.checkpoint.dir``, so a lost executor
costs at most the tasks it was running.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PREFIX = "__tl_"
_fallback: dict[str, str] = {}
_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    ``spark.checkpoint.dir`` names it. Without that setting one temporary folder per process
    is made if the master is local, where all threads share a disk; any other master fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        if "dir" not in _fallback:
            _fallback["dir"] = tempfile.mkdtemp(prefix="tideline-")
        base = _fallback["dir"]
    return base.rstrip("/")


def materialise(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but columnar and compressed. The path is
    kept in ``_tl_path`` of the returned frame for :func:`drop`.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tideline/{tag}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_tl_path"] = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if path in _written:
        _written.remove(path)


def drop(*frames: DataFrame) -> None:
    """Delete what :func:`materialise` wrote; the frames must not be read again."""
    for df in frames:
        path = df.__dict__.pop("_tl_path", None)
        if path:
            _delete(df.sparkSession, path)


def written() -> list[str]:
    """Folders that operators of this process have written and not deleted, oldest first."""
    return list(_written)


def clean_up(spark: SparkSession, before: list[str] | None = None, keep: DataFrame | None = None) -> None:
    """Delete what was written after ``before`` (all if None) except ``keep``.

    A lazy result may still read its operator's intermediates: call this once it has been written.
    """
    spared = {*(before or ()), keep.__dict__.get("_tl_path") if keep is not None else None}
    for path in [p for p in _written if p not in spared]:
        _delete(spark, path)


def split_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join on ``key``, unique in ``right``; the rows of the ``hot(key)`` keys, which must be few, do not move."""
    few = F.broadcast(hot.select(key).distinct())
    first = left.join(few, key, "left_semi").join(F.broadcast(right.join(few, key, "left_semi")), key, "left")
    return first.unionByName(left.join(few, key, "left_anti").join(right, key, "left"))


_held: dict[str, Any] = {}


def held(owner: str, make: Any) -> Any:
    """What ``make()`` gives, kept in this Python worker until a stage of another owner runs in it.

    Workers are used again by later stages; tables and caches of one operator must not lie
    beside those of the next.
    """
    if owner not in _held:
        _held.clear()
        _held[owner] = make()
    return _held[owner]


def release() -> None:
    """Forget what other stages have left in this Python worker."""
    _held.clear()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(col: Column) -> Column:
    return col.cast("binary")


def extended(df: DataFrame, **added: str) -> StructType:
    """The schema of ``df`` and further columns, given as name=type."""
    more = StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in added.items()))
    return StructType([*df.schema.fields, *more.fields])


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that an operator is about to add (case-insensitively)."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns of these names (in any case) renamed, and the new name of every column."""
    low = {n.lower() for n in names}
    new = {c: f"{PREFIX}in_{i}" if c.lower() in low else c for i, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed({c: n for c, n in new.items() if c != n}), new


def restored(df: DataFrame, new: dict[str, str]) -> DataFrame:
    """The columns that :func:`set_aside` was given, under their own names, and no others."""
    return df.select(*[F.col(f"`{n}`").alias(c) for c, n in new.items()])


def labelled_by_crc(col: Column, modulus: int, held: int) -> Column:
    """True for the held-out remainder of crc32(id as text); null ids are held out."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(modulus)) == held, F.lit(True))
