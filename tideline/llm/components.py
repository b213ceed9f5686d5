"""Connected components by alternating large-star and small-star rounds.

Edges stay distributed; each round is two aggregations and two joins, written to
the shared folder. Rounds grow with the logarithm of the component size. The edges of a
centre with very many neighbours do not move: its minimum goes to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialise, split_join

MAX_ROUNDS = 60
#: A node with over this share of the edges is joined without moving them.
HOT_SHARE = 1 / 1024


def _star(edges: DataFrame, large: bool, hot_degree: float) -> DataFrame:
    """One star operation over written edges (u > v); the result, written, has the same form."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    if large:
        both = both.unionAll(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    low = materialise(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"), F.count("*").alias("n")), "low")
    joined = split_join(both, low.select("x", "m"), "x", low.filter(F.col("n") > hot_degree))
    if large:
        out = joined.filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("y").alias("u"), F.col("m").alias("v")).unionAll(
            low.select(F.col("x").alias("u"), F.col("m").alias("v"))
        )
    out = materialise(out.filter("u > v").distinct(), "edges")
    drop(low, edges)
    return out


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component = smallest node.

    Self-loops and repeated edges are harmless; no edges give no rows.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    now = materialise(now, "edges")
    sign = _signature(now)
    for _ in range(MAX_ROUNDS):
        if sign[0] == 0:
            break
        # At most 2 / HOT_SHARE nodes have so many edges.
        hot_degree = sign[0] * HOT_SHARE
        now = _star(_star(now, True, hot_degree), False, hot_degree)
        last, sign = sign, _signature(now)
        if sign == last:
            break
    else:
        raise RuntimeError("connected components did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
