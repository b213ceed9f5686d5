"""Exact top-k inner-product search by a Voronoi kNN join.

1. *Pivots* are a sample of the data, about the square root of its rows, bounded. Every row goes to the cell of its
   nearest pivot and keeps its distance to it.
2. *Summaries.* Each cell lists its row count and the distances of its k + 1 nearest rows to
   the pivot, one row of each id. For a query q, a row x of cell j scores at least q.p_j - |q| d(x, p_j) and at
   most q.p_j + |q| d(x, p_j) (Cauchy-Schwarz). The k-th best lower bound over all
   cells' summaries bounds the k-th best score from below.
3. *Tightening.* Queries are grouped by cell, in blocks of bounded size. Each block is
   first solved against a bounded slice of rows from its own cell, which gives real
   scores and so a better bound.
4. *Replication.* A block needs a row of cell j only if the row's distance to the pivot
   reaches the block's threshold for j. Rows go to exactly those blocks, in
   salted slices, so no task gathers a hot cell. Each (block, slice) is solved
   locally with one matrix product, and the slices' best rows are merged.

On data without clusters the bounds prune little and nearly all rows are needed by
all blocks; results stay exact, the cost is then that of the blocked full scan.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialise

K = 5
#: Fewest and most pivots; in between there are as many as the square root of the rows.
PIVOTS = (32, 1024)
BLOCK_QUERIES = 2048
SLICE_ROWS = 16384
#: Rows that a block of queries is first solved against, shared out among its cells.
PROBE_ROWS = 8192
EXACT = 2**53
LIMIT = 2**63
VEC = "id long, vec array<double>"
HIT = "query_id long, vec_id long, score long"


# ---------------------------------------------------------------- local arithmetic


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, null-free, as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(np.arange(0, n * width + 1, max(width, 1), dtype=np.int32)[: n + 1], rows.ravel())


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products (int64); one beyond 64 bits raises.

    Products of doubles are exact while every partial sum stays below 2**53;
    larger components are multiplied as Python integers.
    """
    if not len(queries) or not len(rows):
        return np.zeros((len(queries), len(rows)), np.int64)
    if np.abs(queries).max() * np.abs(rows).max() * queries.shape[1] < EXACT:
        return (queries @ rows.T).astype(np.int64)
    wide = np.vectorize(int, otypes=[object])
    product = wide(queries).dot(wide(rows).T)
    if any(not -LIMIT <= x < LIMIT for line in product.tolist() for x in line):
        raise OverflowError("an inner product does not fit 64 bits; use a smaller scale")
    return product.astype(np.int64)


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(query index, id, score) of the k best rows of each query, ties to smaller ids; own rows excluded."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    out_q, out_i, out_s = [], [], []
    for at in range(0, len(queries), 256):
        part = scores(queries[at : at + 256], rows)
        own = query_ids[at : at + 256, None] == ids[None, :]
        # A query may meet its own row: one more candidate than k keeps the answer whole.
        extra = k + int(own.sum(axis=1).max(initial=0))
        for r in range(len(part)):
            line = part[r]
            if len(line) > extra:
                floor = np.partition(line, len(line) - extra)[len(line) - extra]
                near = np.flatnonzero(line >= floor)
            else:
                near = np.arange(len(line))
            near = near[~own[r][near]]
            near = near[np.lexsort((ids[near], ~line[near]))][:k]  # ~ reverses order without overflow
            out_q.append(np.full(len(near), at + r))
            out_i.append(ids[near])
            out_s.append(line[near])
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


# ---------------------------------------------------------------- stages


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``(id, vec)`` with vec = floor(scale * x) as doubles; unusable vectors are left out.

    Left out: null vectors, null or non-finite components (also after scaling), null ids.
    Vectors shorter than the longest one, empty ones included, are filled with zeros: an inner
    product runs over the components that both have.
    """
    big = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    fine = F.forall(big, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    # Doubles of 2**52 or more are whole numbers already, and floor would not fit a long.
    whole = F.transform(big, lambda x: F.when(F.abs(x) < F.lit(float(2**52)), F.floor(x).cast("double")).otherwise(x))
    rows = (
        vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
        .filter(fine)
        .select(F.col(id_col).cast("long").alias("id"), whole.alias("vec"))
    )
    sizes = rows.agg(F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high")).first()
    if sizes["low"] == sizes["high"] != 0:
        return rows
    zeros = F.array_repeat(F.lit(0.0), F.lit(max(sizes["high"], 1)) - F.size("vec"))
    return rows.withColumn("vec", F.concat("vec", zeros))


def _assign(pivots: np.ndarray):
    """Nearest pivot of each row and the distance to it, rounded up so that bounds stay bounds."""
    squares = (pivots**2).sum(axis=1)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch.column("vec"))
            cell = (squares - 2 * rows @ pivots.T).argmin(axis=1)
            dist = np.linalg.norm(rows - pivots[cell], axis=1) * (1 + 1e-9) + 1e-6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vec"), pa.array(cell.astype(np.int32)), pa.array(dist)],
                ["id", "vec", "cell", "dist"],
            )

    return stage


def _solve(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        qid = left.column("id").to_numpy()
        q, i, s = best(qid, matrix(left.column("vec")), right.column("id").to_numpy(), matrix(right.column("vec")), k)
        return pa.table({"query_id": pa.array(qid[q]), "vec_id": pa.array(i), "score": pa.array(s)})

    return run


def _thresholds(k: int, pivots: np.ndarray, nearest: list[tuple[int, np.ndarray]]):
    """Per query block: for each cell, the least pivot distance a row must have to matter."""

    def run(key, queries: pa.Table, hits: pa.Table) -> pa.Table:
        vecs, ids = matrix(queries.column("vec")), queries.column("id").to_numpy()
        norms = np.linalg.norm(vecs, axis=1) * (1 + 1e-9) + 1e-9
        at_pivot = vecs @ pivots.T
        # Lower bounds from the summaries: k + 1, since a query may count its own row.
        lower = [at_pivot[:, [j]] - norms[:, None] * d[None, :] for j, d in nearest if len(d)]
        bounds = np.concatenate(lower, axis=1) if lower else np.zeros((len(vecs), 0))
        theta = np.full(len(vecs), -np.inf)
        if bounds.shape[1] > k:
            theta = np.partition(bounds, bounds.shape[1] - k - 1, axis=1)[:, bounds.shape[1] - k - 1]
        if hits.num_rows:
            got = hits.to_pandas().groupby("query_id")["score"].agg(["size", "min"])
            full = got[got["size"] >= k]["min"]
            theta = np.maximum(theta, full.reindex(ids).fillna(-np.inf).to_numpy())
        slack = 1e-9 * (np.abs(theta, where=np.isfinite(theta), out=np.zeros_like(theta)) + np.abs(at_pivot).max(axis=1, initial=0)) + 1e-3
        need = (theta[:, None] - slack[:, None] - at_pivot) / norms[:, None]
        least = need.min(axis=0)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(pivots), pa.string()),
                "cell": pa.array(np.arange(len(pivots), dtype=np.int32)),
                "least": pa.array(np.where(np.isneginf(least), -1.0, least)),
            }
        )

    return run


def _blocks(pivots: np.ndarray, per_cell: dict[int, int], block_queries: int) -> list[tuple[int, int, int]]:
    """(cell, block, parts) of the cells with queries: neighbouring cells together while they fit, big cells in parts."""
    todo = np.array(sorted(per_cell), dtype=np.int64)
    last, chain = pivots[todo[0]] if len(todo) else None, []
    while len(todo):
        at = int(((pivots[todo] - last) ** 2).sum(axis=1).argmin())
        chain.append(int(todo[at]))
        last, todo = pivots[todo[at]], np.delete(todo, at)
    out, block, filled = [], 0, 0
    for cell in chain:
        count = per_cell[cell]
        if filled and filled + count > block_queries:
            block, filled = block + 1, 0
        filled += count
        out.append((cell, block, -(-count // block_queries)))
    return out


# ---------------------------------------------------------------- operator


def search(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    scale: float = 256.0,
    pivots: int | None = None,
    block_queries: int = BLOCK_QUERIES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The k best other rows of every query row: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``id``. Ties go to the smaller id; fewer than k
    candidates give fewer rows. Rows that repeat an id are candidates each on their own
    but never of a query with that id; repeated query ids are answered once. See
    :func:`usable` for vectors that take no part and for mixed dimensions. A score beyond 64
    bits fails. An empty table gives an empty result. ``pivots`` (default: see ``PIVOTS``) rows
    at most are brought to the driver, and one row a cell and query block is made.
    """
    data = usable(vectors, id_col, vec_col, scale)
    out_schema = "query_id long, rank int, vec_id long, score long"
    if pivots is None:
        pivots = min(max(PIVOTS[0], math.isqrt(data.count())), PIVOTS[1])
    sample = data.orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(pivots).select("vec").collect()
    if not sample:
        return data.sparkSession.createDataFrame([], out_schema)
    centres = np.unique(np.array([r["vec"] for r in sample], dtype=np.float64), axis=0)
    cells = materialise(data.mapInArrow(_assign(centres), VEC + ", cell int, dist double"), "cells")
    n = cells.count()

    ranked = Window.partitionBy("cell").orderBy("dist", "id")
    # One row of each id, as a query may return none of the rows that repeat its own.
    once = cells.groupBy("id").agg(F.min(F.struct("dist", "cell")).alias("s")).select("id", "s.dist", "s.cell")
    summary = (
        once.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= k + 1)
        .groupBy("cell").agg(F.sort_array(F.collect_list("dist")).alias("near")).collect()
    )
    nearest = [(r["cell"], np.array(r["near"])) for r in summary]

    per_cell = {r["cell"]: r["count"] for r in cells.filter(is_query).groupBy("cell").count().collect()}
    spark = data.sparkSession
    # One row for each cell with queries: no more than there are pivots.
    grouped = _blocks(centres, per_cell, block_queries)
    named = F.broadcast(spark.createDataFrame(grouped, "cell int, b int, parts int"))
    part = F.pmod(F.xxhash64("id", F.lit("block")), F.col("parts"))
    queries = cells.filter(is_query).dropDuplicates(["id"]).join(named, "cell")
    queries = queries.withColumn("block", F.concat_ws(".", F.col("b").cast("string"), part.cast("string")))
    queries = materialise(queries.select("id", "vec", "cell", "block"), "queries")

    # Tightening: a bounded number of rows, as only a bound is wanted here.
    share = max(2 * k, PROBE_ROWS // max(Counter(b for _, b, _ in grouped).values(), default=1))
    close = Window.partitionBy("cell").orderBy(F.xxhash64("id", F.lit("probe")), "id")
    probe = cells.withColumn("r", F.row_number().over(close)).filter(F.col("r") <= share)
    blocks = queries.select("block", "cell").distinct()
    probe = probe.join(blocks, "cell").select("id", "vec", "block")
    probe = probe.select("id", "vec", F.col("block").alias("to"))
    first = queries.groupBy("block").cogroup(probe.groupBy("to")).applyInArrow(_solve(k), HIT)
    owner = queries.select(F.col("id").alias("query_id"), "block")
    first = first.join(owner, "query_id").select("query_id", "score", F.col("block").alias("to"))
    least = (
        queries.groupBy("block")
        .cogroup(first.groupBy("to"))
        .applyInArrow(_thresholds(k, centres, nearest), "block string, cell int, least double")
    )
    least = materialise(least, "bounds")

    # Replication: one row per (row, block that needs it); a slice holds about slice_rows of them.
    slices = max(1, -(-n // slice_rows))
    needed = cells.join(least, "cell").filter(F.col("dist") >= F.col("least"))
    needed = needed.select("id", "vec", "block", F.pmod(F.xxhash64("id", "dist"), F.lit(slices)).alias("slice"))
    used = needed.select("block", "slice").distinct()
    asked = queries.join(used, "block").select("id", "vec", "block", "slice")
    sent = needed.select("id", "vec", F.col("block").alias("to"), F.col("slice").alias("part"))
    hits = asked.groupBy("block", "slice").cogroup(sent.groupBy("to", "part")).applyInArrow(_solve(k), HIT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    top = materialise(top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "top")
    for done in (cells, queries, least):
        drop(done)
    return top
