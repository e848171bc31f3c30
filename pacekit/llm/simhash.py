"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is cut into ``m`` consecutive segments on a ring. If two fingerprints
differ in at most ``tau`` bits, some segment starts a chain whose every prefix of ``l``
segments differs in at most ``floor(l * tau / m)`` bits (the strong pigeonring principle).
With ``tau < m`` the first segment of that chain is equal and the second differs in one bit at
most, so the first two steps become an equality join: one side emits, per chain start, the
exact key, the other side the exact key and its one-bit neighbours in the second segment. The
remaining steps of the chain, then the full Hamming distance, are checked on the pairs that meet.
With 64 bits, tau 2 and three segments a key has 42 bits or more: almost no accidental pairs
even for billions of documents.

Exact copies are one node (their fingerprint). A key that more than ``bucket`` different
fingerprints share (a large family of near copies) does not enumerate its pairs: its
fingerprints follow the chain to its full length instead, where two of them within two bits
share a one-bit neighbour; each neighbour's smallest fingerprint becomes the hub of a star. So
links grow with the rows, not with the square of a family, and none is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_columns, stored
from .graph import components

SEED = 42
_BLOCK = 1 << 16


def simhash(text: bytes | None, shingle: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit number (no words: 0)."""
    import xxhash
    words = (text or b"").lower().split()          # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    left = n
    while left:                                     # in blocks, so that a very long text stays small
        k = min(left, _BLOCK)
        h = np.fromiter((digest(s, SEED) for s, _ in zip(shingles, range(k))), "<u8", k) if k < left else \
            np.fromiter((digest(s, SEED) for s in shingles), "<u8", k)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= k
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Column of fingerprints of whole texts (null and empty texts: 0)."""
    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in s], dtype="int64")
    return run(F.coalesce(text, F.lit("")).cast("binary"))


def _segments(m: int) -> list[tuple[int, int]]:
    """(first bit, width) of m segments of 64 bits; the later ones take the odd bits."""
    cut = [64 * i // m for i in range(m + 1)]
    return [(cut[i], cut[i + 1] - cut[i]) for i in range(m)]


def _segment(fp: Column, seg: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(fp, seg[0]).bitwiseAND(F.lit((1 << seg[1]) - 1))


def _chain_keys(fp: Column, m: int) -> Column:
    """The exact keys of a fingerprint, one per chain start: the first two segments of the chain."""
    segs = _segments(m)
    return F.array(*[F.struct(F.lit(i).alias("i"), _segment(fp, segs[i]).bitwiseOR(
        F.shiftleft(_segment(fp, segs[(i + 1) % m]), segs[i][1])).alias("v")) for i in range(m)])


def _near_keys(start: Column, key: Column, tau: int, m: int) -> Column:
    """A key and, where the budget allows a difference in the second segment, its one-bit neighbours there."""
    if 2 * tau // m < 1:
        return F.array(key)
    segs = _segments(m)
    at = F.element_at(F.array(*[F.lit(s[1]) for s in segs]), start + 1)
    width = F.element_at(F.array(*[F.lit(segs[(i + 1) % m][1]) for i in range(m)]), start + 1)
    flips = F.transform(F.sequence(F.lit(0), width - 1), lambda j: key.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), at + j)))
    return F.concat(F.array(key), flips)


def _chain_ok(x: Column, start: Column, tau: int, m: int) -> Column:
    """All prefixes of the chain from ``start`` keep their budget; the last one is the full distance."""
    bits = F.array(*[F.bit_count(_segment(x, s)) for s in _segments(m)])
    ok = F.lit(True)
    for length in range(1, m + 1):
        total = sum((F.element_at(bits, (start + k) % m + 1) for k in range(length)), F.lit(0))
        ok = ok & (total <= length * tau // m)
    return ok


def links(classes: DataFrame, tau: int = 2, m: int = 3, bucket: int = 32) -> DataFrame:
    """Links ``(a, b)`` between the different fingerprints in ``classes(fp)``: their connected
    components are those of all pairs within ``tau`` bits. ``tau`` is 0, 1 or 2, ``m > tau``."""
    if not 0 <= tau <= 2 or m <= tau:
        raise ValueError("tau must be 0, 1 or 2, and smaller than the number of segments")
    fp = F.col("fp")
    exact = classes.select("fp", F.explode(_chain_keys(fp, m)).alias("k")).select("fp", "k.i", "k.v")
    # a key fixes two of the segments, so its fingerprints are bounded by the bits it leaves open
    exact = exact.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("i", "v")))
    exact = stored(exact, "chain-keys")
    near = exact.select(fp.alias("a"), "i", F.explode(_near_keys(F.col("i"), F.col("v"), tau, m)).alias("v"))
    cold = exact.where(F.col("n") <= bucket).select(F.col("fp").alias("b"), "i", "v")
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (near.join(cold.hint("shuffle_hash"), ["i", "v"])
                 .where((F.col("a") < F.col("b")) & _chain_ok(x, F.col("i"), tau, m))
                 .where(F.bit_count(x) <= tau).select("a", "b").distinct())
    hot_keys = exact.where(F.col("n") > bucket).select("i", "v").distinct()
    hot = near.join(hot_keys, ["i", "v"], "left_semi").select("a").distinct()
    flips = F.concat(F.array(F.col("a")), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda j: F.col("a").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), j))) if tau else F.array().cast("array<bigint>"))
    if tau == 2:
        spread = hot.select("a", F.explode(flips).alias("node"))
        hubs = spread.groupBy("node").agg(F.min("a").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
        stars = spread.join(hubs, "node").where("a <> hub").select("a", F.col("hub").alias("b"))
    else:  # within one bit, a fingerprint is itself a neighbour of the other
        spread = hot.select("a", F.explode(flips).alias("b"))
        stars = spread.join(hot.select(F.col("a").alias("b")), "b").where("a < b").select("a", "b")
    return pairs.union(stars.distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    tau: int = 2, m: int = 3, bucket: int = 32) -> DataFrame:
    """``(id, fp, component)`` for every row of ``docs``: its fingerprint and the smallest id of
    its component of fingerprints linked at ``tau`` bits or fewer.

    Null and empty texts have fingerprint 0 and are linked like any other; a component without
    any id has a null component; repeated rows each get a row; an empty table gives no rows.
    """
    return _grouped(docs, id_col, text_col, shingle, tau, m, bucket).select("id", "fp", "component")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, tau: int, m: int = 3, bucket: int = 32) -> DataFrame:
    """:func:`near_duplicates` with the ``root`` of each component: where ids repeat, two of them may have one smallest id."""
    rows = stored(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "fp")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "fp-classes")
    roots = components(links(classes, tau, m, bucket)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = stored(rooted.join(least, "root").select("fp", "component", "root"), "fp-components")
    return rows.join(named, "fp").select("id", "fp", "component", "root")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, tau: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Rows of a component that repeat that id count once; an id with different texts may lose in one
    component and stay in another. Rows without an id stay only where their component has none with
    an id, once per component root.
    """
    c_gone, c_again, c_fp, c_root = scratch_columns(docs, "_gone", "_again", "_fp", "_root")
    found = stored(_grouped(docs, id_col, text_col, shingle, tau), "near")
    with_id = found.where("id IS NOT NULL")
    gone = stored(with_id.where("id <> component").select(F.col("id").alias(c_gone)).distinct(), "gone")
    won = with_id.where("id = component")
    # ids that stay, but not with all their rows: only these are told apart by their texts
    repeated = won.groupBy("id").count().where("count > 1").select("id")
    again = stored(repeated.union(won.join(gone, F.col("id") == F.col(c_gone), "left_semi").select("id")).distinct()
                   .select(F.col("id").alias(c_again)), "again")
    kept = docs.where(F.col(id_col).isNotNull()).join(gone, F.col(id_col) == F.col(c_gone), "left_anti")
    once = kept.join(again, F.col(id_col) == F.col(c_again), "left_anti")
    places = stored(won.join(again, F.col("id") == F.col(c_again), "left_semi")
                       .select(F.col("id").alias(c_again), F.col("fp").alias(c_fp), F.col("root").alias(c_root)).distinct(), "places")
    several = docs.join(again, F.col(id_col) == F.col(c_again), "left_semi").withColumn(c_gone, fingerprint(F.col(text_col), shingle))
    twice = (several.join(places, (F.col(id_col) == F.col(c_again)) & (F.col(c_gone) == F.col(c_fp)))
                    .dropDuplicates([id_col, c_root]).select(*docs.columns))
    out = once.unionByName(twice)
    nameless = found.where("id IS NULL AND component IS NULL").select("fp").distinct()
    if nameless.isEmpty():
        return out
    roots = components(links(nameless, tau)).withColumnRenamed("node", "fp")
    rooted = nameless.join(roots, "fp", "left").select(F.col("fp").alias(c_fp), F.coalesce("root", "fp").alias(c_root))
    rest = (docs.where(F.col(id_col).isNull()).withColumn(c_fp, fingerprint(F.col(text_col), shingle))
                .join(rooted, c_fp).dropDuplicates([c_root]).select(*docs.columns))
    return out.unionByName(rest)
