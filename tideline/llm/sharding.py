"""Balanced sharding by histogram sort (native DataFrame operations only).

Rows are ordered by a 64-bit key (a hash of the row, so shards are shuffled).
Splitters between shards are found by counting exact bytes below candidate
boundaries: each round cuts the open key intervals into ``2 ** RADIX_BITS``
probes, sums bytes and rows between neighbouring probes over all partitions, and
keeps for every splitter only the probe interval its target lies in. A splitter is
settled once the interval holds no more than the tolerance, or is one key.
Then all rows move once, to the sub-range of the sorted order they belong to.

The rows are read twice: once to write (key, size) of each, from which all histograms are
counted, and once to be moved. Only histograms reach the driver: at most
``shards * 2 ** RADIX_BITS`` rows a round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialise, without

RADIX_BITS = 12
KEY_BITS = 64
TOLERANCE = 0.001
RANGE_ROWS = 1_000_000
KEY, SIZE, RANGE = "__tl_key", "__tl_size", "__tl_range"


@dataclass(frozen=True)
class Cut:
    """Rows with a key below ``key`` (unsigned) lie left of the cut."""

    key: int
    rows: int
    size: int


def default_key(columns: list[str]) -> Column:
    """A hash of all columns, so that rows without an id, or with one id, spread as others do."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _bucket(shift: int) -> Column:
    """The leading bits of the key, as an unsigned number."""
    return F.shiftrightunsigned(F.col(KEY), shift)


def _histogram(rows: DataFrame, shift: int, up: int, parents: list[int]) -> dict[int, tuple[int, int]]:
    """{leading bits: (rows, bytes)} of the rows whose shorter leading bits are in ``parents``."""
    if up < KEY_BITS:
        rows = rows.filter(_bucket(up).isin(parents))
    got = rows.groupBy(_bucket(shift).alias("b")).agg(F.count("*").alias("n"), F.sum(SIZE).alias("s")).collect()
    # A 64-bit bucket number is signed in the engine.
    return {r["b"] % 2**KEY_BITS: (r["n"], r["s"]) for r in got}


def splitters(rows: DataFrame, shares: list[float], tolerance: float) -> tuple[list[Cut], Cut]:
    """Cuts at ``shares`` (ascending, in 0..1) of all bytes of ``rows(KEY, SIZE)``, and the total.

    Each cut is exact about the rows and bytes on its left, and within
    ``tolerance`` bytes of its target unless one key or one row is heavier.
    """
    open_at: dict[int, tuple[int, int, list[int]]] = {0: (0, 0, list(range(len(shares))))}
    settled: dict[int, Cut] = {}
    total, up = None, KEY_BITS
    while open_at:
        shift = max(0, up - RADIX_BITS)
        got = _histogram(rows, shift, up, sorted(open_at))
        if total is None:
            total = Cut(2**KEY_BITS, sum(n for n, _ in got.values()), sum(s for _, s in got.values()))
        digit = up - shift
        by_parent: dict[int, list[int]] = {}
        for b in sorted(got):
            by_parent.setdefault(b >> digit, []).append(b)
        following: dict[int, tuple[int, int, list[int]]] = {}
        for parent, (left_rows, left_size, wanted) in open_at.items():
            wanted = list(wanted)
            for b in by_parent.get(parent, []):
                n, s = got[b]
                while wanted and shares[wanted[0]] * total.size <= left_size + s:
                    target = shares[wanted[0]] * total.size
                    low, high = target - left_size, left_size + s - target
                    if low <= tolerance and low <= high:
                        settled[wanted.pop(0)] = Cut(b << shift, left_rows, left_size)
                    elif high <= tolerance or not shift:
                        near = Cut(b << shift, left_rows, left_size) if low <= high else Cut((b + 1) << shift, left_rows + n, left_size + s)
                        settled[wanted.pop(0)] = near
                    else:
                        following.setdefault(b, (left_rows, left_size, []))[2].append(wanted.pop(0))
                left_rows, left_size = left_rows + n, left_size + s
            for k in wanted:  # targets beyond the last row of the interval
                settled[k] = Cut((parent + 1) << up, left_rows, left_size)
        open_at, up = following, shift
    return [settled[k] for k in range(len(shares))], total


def _below(cut: Cut) -> Column:
    """KEY (unsigned) < cut.key; flipping the sign bit makes signed order unsigned order."""
    if cut.key >= 2**KEY_BITS:
        return F.lit(True)
    flipped = cut.key - 2 ** (KEY_BITS - 1)
    return F.col(KEY).bitwiseXOR(F.lit(-(2**63))) < F.lit(flipped)


def _range_of(cuts: list[Cut]) -> Column:
    """Number of cuts at or below the key, by a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(_below(cuts[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

    return tree(0, len(cuts))


def shard(
    rows: DataFrame,
    size: Column,
    shards: int,
    id_col: str = "doc_id",
    key: Column | None = None,
    tolerance: float = TOLERANCE,
    range_rows: int = RANGE_ROWS,
    max_ranges: int = 4096,
) -> DataFrame:
    """All rows and columns plus ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each).

    Shards hold nearly equal sums of ``size``: every boundary lies within
    ``tolerance`` of a mean shard from its ideal place, unless a single row or key is
    heavier. Rows of one key stay together in key order; ties are ordered by id. ``key`` must be a
    function of the row; the default is a hash of all columns, so only rows that are equal in
    all of them share a key, whatever their ids, null or not. ``size`` must not be null. Fewer
    rows than shards leave shards empty. Input columns named shard or slot are replaced.

    Slots need no single task a shard: a shard is cut into sub-ranges of about ``range_rows``
    rows, and the histogram gives the number of rows before each. There are at most
    ``max_ranges`` sub-ranges in all, as each is a splitter to find on the driver (4096 of them
    keep a round's histogram below 2 ** 24 rows); from 4 billion rows on they grow instead.
    """
    keyed = without(rows, "shard", "slot")
    keyed = keyed.withColumn(KEY, key if key is not None else default_key(keyed.columns)).withColumn(SIZE, size.cast("long"))
    slim = materialise(keyed.select(F.col(KEY).cast("long").alias(KEY), SIZE), "keys")
    n, weight = slim.agg(F.count("*"), F.sum(SIZE)).first()
    pieces = max(1, min(-(-n // (range_rows * shards)), max_ranges // shards))
    shares = [k / (shards * pieces) for k in range(1, shards * pieces)]
    mean = (weight or 0) / shards
    cuts, _ = splitters(slim, shares, tolerance * mean) if n and shares else ([Cut(2**KEY_BITS, 0, 0)] * len(shares), None)
    drop(slim)
    starts = [0, *[c.rows for c in cuts]]
    ranges = F.array(*[F.lit(starts[r] - starts[r - r % pieces]).cast("long") for r in range(len(starts))])
    moved = keyed.withColumn(RANGE, _range_of(cuts)).repartition(RANGE)
    order = Window.partitionBy(RANGE).orderBy(F.col(KEY).bitwiseXOR(F.lit(-(2**63))), F.col(id_col))
    out = moved.withColumn("slot", F.row_number().over(order).cast("long") - 1 + F.element_at(ranges, F.col(RANGE) + 1))
    out = out.withColumn("shard", F.floor(F.col(RANGE) / pieces).cast("int"))
    return out.drop(KEY, SIZE, RANGE)
