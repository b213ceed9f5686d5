"""Data source ``changelog``: a change log in Parquet files, as a batch or a stream.

    spark.dataSource.register(ChangeLogSource)
    spark.read.format("changelog").schema(...).option("path", folder).load()
    spark.readStream.format("changelog").schema(...).option("path", folder).load()

The log needs columns ``lsn`` and ``xid``; any others pass through. Transactions follow one another
in the log, as a log in commit order has them. Stream offsets are log
positions, ``{"lsn": n}``, and always lie at the end of a transaction, so a micro-batch holds
whole transactions. If the log has begin or commit events (column ``kind``), a transaction ends at its
commit, and one without a commit is not read yet; else it ends with its last row.

The driver reads the files' footers for the positions in them, and of the log itself only what the next
``maxTransactions`` ends need. Options:

* ``path``: the folder (or file) of Parquet files; must be visible to all executors
* ``startingOffset``: read only what lies after this position (default -1: everything)
* ``maxTransactions``: most transactions in one micro-batch (default 1000)
* ``partitions``: most parallel readers of a batch (default 4), of about as many rows each; a small batch has fewer
* ``commits``: ``events`` or ``rows`` say how transactions end; ``auto`` (default) looks at the first rows
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

MAX_TRANSACTIONS = 1000
PARTITIONS = 4
#: A batch of no more than this is read by one task: starting more costs more than the rows.
READER_ROWS, READER_BYTES = 10_000, 4 << 20
#: Row groups of a written log.
GROUP_BYTES = 1 << 20


class Range(InputPartition):
    """Positions after ``low`` up to and including ``high``, and the row groups of each file that have some (None: look in all)."""

    def __init__(self, low: int, high: int, groups: dict[str, list[int]] | None = None):
        self.low, self.high, self.groups = low, high, groups


class OptionError(ValueError):
    pass


class _Log:
    def __init__(self, options: dict[str, str], schema: StructType):
        lowered = {k.lower(): v for k, v in options.items()}
        if "path" not in lowered:
            raise OptionError("changelog needs the option path")
        self.path = lowered["path"].removeprefix("file://")
        self.start = self._number(lowered, "startingoffset", -1)
        self.limit = self._number(lowered, "maxtransactions", MAX_TRANSACTIONS)
        self.parts = self._number(lowered, "partitions", PARTITIONS)
        if self.limit < 1 or self.parts < 1:
            raise OptionError("maxTransactions and partitions must be positive")
        self.commits = lowered.get("commits", "auto")
        if self.commits not in ("auto", "events", "rows"):
            raise OptionError(f"commits must be auto, events or rows, not {self.commits!r}")
        self.schema = schema
        self.footers: dict[str, tuple] = {}
        missing = {"lsn", "xid"} - set(schema.names)
        if missing:
            raise OptionError(f"the schema lacks {sorted(missing)}")

    @staticmethod
    def _number(options: dict[str, str], name: str, default: int) -> int:
        try:
            return int(options.get(name, default))
        except ValueError:
            raise OptionError(f"{name} must be a whole number, not {options[name]!r}") from None

    def dataset(self) -> ds.Dataset:
        return ds.dataset(self.path, format="parquet")

    def pieces(self, after: int) -> list[tuple[int, int, int, ds.Fragment]]:
        """(first position, last position, rows, row group) of what lies after a position, by first position.

        Footers are kept until a file changes, as every micro-batch asks again.
        """
        data, out = self.dataset(), []
        known = {i.path: (i.size, i.mtime_ns) for i in data.filesystem.get_file_info(data.files)}
        self.footers = {path: kept for path, kept in self.footers.items() if known.get(path) == kept[0]}
        for fragment in data.get_fragments():
            if fragment.path not in self.footers:
                self.footers[fragment.path] = known[fragment.path], self._row_groups(fragment)
            out += [p for p in self.footers[fragment.path][1] if p[1] > after]
        return sorted(out, key=lambda p: p[:3])

    def _row_groups(self, fragment: ds.Fragment) -> list[tuple[int, int, int, ds.Fragment]]:
        out = []
        for group in fragment.split_by_row_group():
            info = group.row_groups[0]
            known = (info.statistics or {}).get("lsn")
            if known is None and info.num_rows:
                found = pc.min_max(group.to_table(columns=["lsn"]).column("lsn")).as_py()
                known = None if found["min"] is None else found
            if known is not None:
                out.append((known["min"], known["max"], info.num_rows, group))
        return out

    def ranges(self, low: int, high: int) -> list[Range]:
        """Cuts between row groups, so that every reader has about as many rows; inside one, by position."""
        inside = [p for p in self.pieces(low) if p[0] <= high]
        # The part of a row group's rows and bytes that lies in the range.
        shares = [(min(last, high) - max(first - 1, low)) / (last - first + 1) for first, last, _, _ in inside]
        total = sum(n * share for (_, _, n, _), share in zip(inside, shares))
        size = sum(group.row_groups[0].total_byte_size * share for (_, _, _, group), share in zip(inside, shares))
        parts = min(self.parts, max(1, math.ceil(total / READER_ROWS), math.ceil(size / READER_BYTES)))
        cuts, seen = [], 0.0
        for (first, last, n, _), share in zip(inside, shares):
            first, last, n = max(first - 1, low), min(last, high), n * share
            for k in range(1, parts):
                wanted = total * k / parts
                if seen <= wanted < seen + n:
                    cuts.append(first + int((last - first) * (wanted - seen) / n))
            seen += n
        bounds = sorted({low, *[c for c in cuts if low < c < high], high})
        return [Range(a, z, self._groups(inside, a, z)) for a, z in zip(bounds, bounds[1:])]

    @staticmethod
    def _groups(pieces: list, low: int, high: int) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for first, last, _, group in pieces:
            if first <= high and last > low:
                out.setdefault(group.path, []).append(group.row_groups[0].id)
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        inside = (ds.field("lsn") > part.low) & (ds.field("lsn") <= part.high)
        for batch in self._batches(part, inside):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pc.cast(batch.column(f.name), f.type) for f in target], schema=target)

    def _batches(self, part: Range, inside: pc.Expression) -> Iterator[pa.RecordBatch]:
        data = self.dataset()
        if part.groups is None:
            yield from data.to_batches(columns=self.schema.names, filter=inside)
            return
        for path, numbers in part.groups.items():
            fragment = data.format.make_fragment(path, data.filesystem, row_groups=numbers)
            yield from fragment.to_batches(schema=data.schema, columns=self.schema.names, filter=inside)

    def _by_commit(self, pieces: list) -> bool:
        """Whether commit events end the transactions."""
        if self.commits != "auto":
            return self.commits == "events"
        if not pieces or "kind" not in pieces[0][3].physical_schema.names:
            return False
        head = pieces[0][3].head(1000, columns=["kind"]).column("kind")
        return bool(pc.any(pc.is_in(head, pa.array(["begin", "commit"]))).as_py())

    def ends(self, after: int, limit: int | None = None) -> list[tuple[int, int]]:
        """(last position, xid) of the first ``limit`` transactions after a position, in order."""
        pieces = self.pieces(after)
        by_commit = self._by_commit(pieces)
        wanted = ds.field("lsn") > after
        if by_commit:
            wanted &= ds.field("kind") == "commit"
        last: dict[int, int] = {}
        for k, (_, _, _, group) in enumerate(pieces):
            table = group.to_table(columns=["lsn", "xid"], filter=wanted).group_by("xid").aggregate([("lsn", "max")])
            for xid, lsn in zip(table.column("xid").to_pylist(), table.column("lsn_max").to_pylist()):
                last[xid] = max(lsn, last.get(xid, lsn))
            # What ends before the next row group begins cannot change any more.
            if limit is not None and k + 1 < len(pieces):
                settled = sorted(lsn for lsn in last.values() if lsn < pieces[k + 1][0])
                if len(settled) > limit:  # one more: without commit events the last may go on
                    break
        return sorted((lsn, xid) for xid, lsn in last.items())[:limit]

    def last_end(self, after: int) -> int | None:
        """The end of the last whole transaction; only the last row groups are looked at."""
        pieces = self.pieces(after)
        if not self._by_commit(pieces):
            return max((p[1] for p in pieces), default=None)
        best = None
        for _, high, _, group in sorted(pieces, key=lambda p: -p[1]):
            if best is not None and high <= best:
                break
            found = group.to_table(columns=["lsn"], filter=(ds.field("lsn") > after) & (ds.field("kind") == "commit"))
            if found.num_rows:
                best = max(best or 0, pc.max(found.column("lsn")).as_py())
        return best


def log_end(path: str, after: int = -1) -> int:
    """The position of the log's last whole transaction, or ``after``: where a snapshot taken now belongs."""
    found = _Log({"path": path}, StructType().add("lsn", "long").add("xid", "long")).last_end(after)
    return after if found is None else found


class BatchReader(DataSourceReader):
    def __init__(self, log: _Log):
        self.log = log

    def partitions(self) -> list[Range]:
        last = self.log.last_end(self.log.start)
        return self.log.ranges(self.log.start, last) if last is not None else [Range(0, -1)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, log: _Log):
        self.log = log
        self.at: int | None = None
        self.committed: int | None = None

    def initialOffset(self) -> dict[str, int]:
        return {"lsn": self.log.start}

    def latestOffset(self) -> dict[str, int]:
        """The end of the last transaction to read now; advances by ``maxTransactions`` at most."""
        after = self.log.start if self.at is None else self.at
        ends = self.log.ends(after, self.log.limit)
        self.at = ends[-1][0] if ends else after
        return {"lsn": self.at}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        self.at = max(end["lsn"], self.at if self.at is not None else end["lsn"])
        return self.log.ranges(start["lsn"], end["lsn"]) if end["lsn"] > start["lsn"] else []

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)

    def commit(self, end: dict[str, int]) -> None:
        """All rows up to ``end`` are durable: the acknowledgement to the source."""
        self.committed = end["lsn"]


class ChangeLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self) -> str:
        return "lsn bigint, seq int, xid bigint, kind string, relid bigint, key string, value string"

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(_Log(dict(self.options), schema))

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(_Log(dict(self.options), schema))


def write_log(log: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> None:
    """Write a log in its order and in small row groups, so that a micro-batch reads little besides its own rows.

    The log is kept on disk meanwhile: the ranges are sampled from it, and it would be made once more for that.
    """
    own = log.storageLevel == StorageLevel.NONE
    if own:
        log.persist(StorageLevel.DISK_ONLY)
    try:
        ordered = log.repartitionByRange("lsn").sortWithinPartitions("lsn")
        ordered.write.option("parquet.block.size", group_bytes).parquet(path)
    finally:
        if own:
            log.unpersist()


def register(spark: Any) -> None:
    spark.dataSource.register(ChangeLogSource)
