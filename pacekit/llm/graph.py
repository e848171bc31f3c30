"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest node reachable.

    Each round is a pair of aggregations and joins on the edge table, written to the shared
    folder; the rounds grow with the logarithm of the longest path. Only one number and one
    checksum per round reach the driver. Self loops and repeated edges are allowed; an empty
    table gives an empty result.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               "edges")
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        before, e = e, stored(_small_star(_large_star(e)), "edges")
        discard(before)
    # a fixed point is a set of stars: every edge points at its root
    roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
