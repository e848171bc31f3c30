"""Nearest neighbours by inner product with a block matrix join.

Vectors are packed into blocks: int8 codes with one scale per vector, the length of each rounding
error, and the original numbers. Every block of queries meets every block of candidates in a tile.
The tile multiplies the int8 codes (exact: products and sums of small integers) and bounds the
error that quantisation can have made; a candidate whose upper bound is below the k-th best lower
bound of its query is out. The survivors' products are computed again on the original vectors, in
double precision and in the order of the components, and each query's best go on as a heap of k
rows at most, which an aggregation by query merges.

The result is exact: the bounds hold for every pair. A vector that a third of all rows share is
spread over the blocks like any other; in a tile its rows tie, and ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

_BLOCKS = "dim int, block long, ids binary, vectors binary"


def usable(v: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)


def _quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes (as whole float32 numbers), scales, lengths of the rounding errors and of the decoded vectors."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0                               # a subnormal vector: all error
    code = np.rint(x / scale[:, None]).astype(np.int8)
    back = code * scale[:, None]
    return code, scale, np.sqrt(((x - back) ** 2).sum(axis=1)), np.sqrt((back ** 2).sum(axis=1))


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * c[:, d]
    return total


def tile(q_ids, q, c_ids, c, k: int, step: int = 256) -> pd.DataFrame:
    """The best ``k`` candidates of each query in one tile, found through int8 bounds."""
    qc, qs, qe, qn = _quantise(q)
    cc, cs, ce, cn = _quantise(c)
    wide = cc.astype(np.float32).T                        # whole numbers below 2^24 are exact in float32
    exact32 = q.shape[1] * 127 * 127 < 1 << 24
    out = []
    for lo in range(0, len(q), step):
        hi = min(lo + step, len(q))
        part = qc[lo:hi].astype(np.float32) @ wide if exact32 else qc[lo:hi].astype(np.float64) @ cc.astype(np.float64).T
        near = part * (qs[lo:hi, None] * cs[None, :])
        # |q.c - q'.c'| <= |q'| |c - c'| + |q - q'| |c'| + |q - q'| |c - c'|, and a little for rounding
        slack = qn[lo:hi, None] * ce + qe[lo:hi, None] * (cn + ce)
        slack += 1e-9 * (qn[lo:hi, None] + qe[lo:hi, None]) * (cn + ce)
        own = q_ids[lo:hi, None] == c_ids[None, :]
        low = np.where(own, -np.inf, near - slack)
        kth = np.partition(low, len(c) - k, axis=1)[:, len(c) - k] if len(c) > k else np.full(hi - lo, -np.inf)
        rows, cols = np.nonzero((near + slack >= kth[:, None]) & ~own)
        for at in range(0, len(rows), 1 << 16):           # survivors in bounded parts
            r, s = rows[at:at + (1 << 16)] + lo, cols[at:at + (1 << 16)]
            out.append(pd.DataFrame({"query_id": q_ids[r], "vec_id": c_ids[s], "score": _exact(q[r], c[s])}))
    if not out:
        return pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})
    found = pd.concat(out).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return found.groupby("query_id", sort=False).head(k)


def _packed(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows ``(dim, id, v)`` as blocks of about ``block_rows``: the hash of a row names its block."""
    blocks = max(1, -(-rows.count() // block_rows))

    def pack(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("id", kind="stable")
        return pd.DataFrame({"dim": [f["dim"].iloc[0]], "block": [f["block"].iloc[0]], "ids": [f["id"].to_numpy("<i8").tobytes()],
                             "vectors": [np.stack(f["v"].to_list()).astype("<f8").tobytes()]})
    placed = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    return placed.groupBy("dim", "block").applyInPandas(pack, _BLOCKS)


def search(queries: DataFrame, candidates: DataFrame, k: int = 20, block_rows: int = 4096, query_rows: int = 1024,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` candidates of largest inner product.

    Candidates are of the query's dimension and have another id (a row is not its own neighbour);
    fewer than ``k`` give fewer rows. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows without an id. Equal scores go to the smaller
    id; rows that repeat an id count once per distinct vector; empty tables give no rows.
    """
    def side(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        return (df.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))
                  .where(F.col("id").isNotNull() & usable(F.col("v"))).distinct().select(F.size("v").alias("dim"), "id", "v"))
    q = stored(_packed(side(queries), query_rows), "query-blocks")
    c = stored(_packed(side(candidates), block_rows), "candidate-blocks")
    # every query block meets every candidate block of its dimension: a grid of tiles, spread by tile
    grid = (q.select("dim", F.col("block").alias("qb")).join(c.select("dim", F.col("block").alias("cb")), "dim"))
    paired = (grid.join(q.select("dim", F.col("block").alias("qb"), F.col("ids").alias("qi"), F.col("vectors").alias("qv")), ["dim", "qb"])
                  .join(c.select("dim", F.col("block").alias("cb"), F.col("ids").alias("ci"), F.col("vectors").alias("cv")), ["dim", "cb"])
                  .repartition(F.col("dim"), F.col("qb"), F.col("cb")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, qi, qv, ci, cv in zip(f["dim"], f["qi"], f["qv"], f["ci"], f["cv"]):
                yield tile(np.frombuffer(qi, "<i8"), np.frombuffer(qv, "<f8").reshape(-1, dim),
                           np.frombuffer(ci, "<i8"), np.frombuffer(cv, "<f8").reshape(-1, dim), k)
    best = paired.select("dim", "qi", "qv", "ci", "cv").mapInPandas(run, "query_id long, vec_id long, score double")
    # heaps of k rows at most a tile; merged by query
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
