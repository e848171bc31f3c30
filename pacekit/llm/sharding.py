"""Proportional stratified interleaving of rows into shards, with DataFrame operations only.

Every source's rows are put into a seeded order; a row of rank ``r`` among its source's ``n``
rows gets the fractional rank ``(2r + 1) / 2n``. Sorting all rows by it interleaves the sources
in proportion, and cutting the sorted rows at equal counts gives shards that each hold every
source's share, to within a row per source and cut. Counts of shards are at most one apart.

Ranks come from range partitions (Spark samples the keys, so a source with a third of all rows
spreads over many tasks) and one offset per partition, never from a window over a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_index
from .common import stored


def seeded(seed: int, key: Column) -> Column:
    """A seeded number in [0, 2^60) for a key: the first 15 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")),
                              1, 15), 16, 10).cast("long")


def interleave(rows: DataFrame, source: str, order: list[str], shards: int) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in a shard).

    ``order`` is the seeded order inside a source; rows equal in it are interchangeable. Rows
    without a source form a source of their own; it goes first where fractional ranks tie. Fewer
    rows than shards leave shards empty; an empty table gives no rows. ``rows`` should be narrow:
    it is sorted twice. Columns named ``_*`` are for internal use.
    """
    first = stored(global_index(rows, [F.col(source).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]],
                                "_at"), "by-source")
    size = stored(first.groupBy(F.col(source).alias("_source"))
                       .agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_n")), "source-sizes")
    total = size.agg(F.sum("_n")).first()[0] or 0
    ranked = (first.join(size, F.col(source).eqNullSafe(F.col("_source")))
                   .withColumn("_frac", (2 * (F.col("_at") - F.col("_start")) + 1) / (2 * F.col("_n"))))
    placed = global_index(ranked, [F.col("_frac"), F.col("_start")], "_pos")
    total = max(total, 1)
    shard = F.expr(f"(_pos * {shards}L) div {total}L")
    start = F.expr(f"(_shard * {total}L + {shards - 1}L) div {shards}L")
    return (placed.withColumn("_shard", shard)
                  .select(*rows.columns, F.col("_shard").cast("int").alias("shard"),
                          (F.col("_pos") - start).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 9, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, text_crc32, shard, slot)`` for every row.

    Size is the text's UTF-8 bytes plus one (null text: 1, CRC of no bytes). Null ids and
    repeated rows are placed like any other.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                       seeded(seed, F.col(id_col)).alias("draw"))
    return interleave(rows, "source", ["draw", "doc_id", "text_crc32", "size"], shards).drop("draw")
