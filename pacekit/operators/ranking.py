"""Exact per-group ranks and medians that never put one group into one task.

A window ``partitionBy(group)`` sends a whole group to a single task, and an
exact ``percentile``/``median`` aggregate merges every value of a group in one
buffer.  When one group holds a third of all rows both become the bottleneck.

Here the rows are range-partitioned on ``(group, order)`` -- Spark samples the
keys, so a hot group is cut across many partitions -- and sorted inside each
partition.  Every row then gets a global position (partition offset + index in
partition); the sorted positions are fixed once with a reliable checkpoint so
that every later branch sees the same numbering.  Group boundaries come from a
plain aggregation (map-side combined), and values at chosen ranks are fetched
with an equi-join on the unique position, which has no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, cut_to_files
from .joins import join_checked, join_null_safe

_POS_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row_in_partition


def _numbered(df: DataFrame, group_cols: list[str], order_cols: list, n_parts: int | None = None) -> DataFrame:
    """Range-partition + sort on (group, order); ``_pid`` / ``_lpos`` number the rows, to be fixed by a cut."""
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group_cols] + [F.col(c) if isinstance(c, str) else c for c in order_cols]
    return (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_lpos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), _POS_BITS)))


def _positions(df: DataFrame, group_cols: list[str], order_cols: list, n_parts: int | None = None) -> DataFrame:
    """Add ``_gpos``: 0-based global position in (group, order) sort order."""
    s = cut_lineage(_numbered(df, group_cols, order_cols, n_parts))  # one fixed numbering for all branches below
    sizes = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a proven size bound, safe to broadcast
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offsets), "_pid")
             .withColumn("_gpos", F.col("_off") + F.col("_lpos"))
             .drop("_pid", "_lpos", "_off"))


def group_row_number(df: DataFrame, group_cols: list[str], order_cols: list, out: str = "rn",
                     within: dict[str, list[str]] | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order_cols)`` without a per-group task.

    ``order_cols`` must make the order total inside a group for a deterministic result. ``within`` gives further
    numbers by the same order, in the groups that its columns divide each group into (name -> columns): they take
    the same sort, a row's number being that in its partition after what the earlier partitions hold.
    """
    fixed = s = cut_to_files(_numbered(df, group_cols, order_cols))  # one fixed numbering for all branches below
    for name, more in [(out, []), *(within or {}).items()]:
        groups = [*group_cols, *more]
        # a row per group and partition
        sizes = fixed.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_lpos").alias("_start"))
        earlier = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        before = sizes.select("_pid", *groups, "_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        if more:
            s = s.withColumn("_here", F.row_number().over(Window.partitionBy("_pid", *groups).orderBy("_lpos")))
        # a group's rows lie side by side in a partition's order: there the place itself is the number
        here = F.col("_here") if more else F.col("_lpos") - F.col("_start") + 1
        s = join_null_safe(s, before, ["_pid", *groups]).withColumn(name, (F.col("_before") + here).cast("int")).drop("_start", "_before", "_here")
    return s.drop("_pid", "_lpos")


def _counted_positions(df: DataFrame, group_cols: list[str], value: str) -> DataFrame:
    """Distinct values with ``_from`` / ``_to``: the 0-based global ranks that their rows take.

    Equal values are counted first (map-side combined), so a value that a third of all rows
    share is one row here and a group of few values still uses every task that read it.
    """
    base = df.select(*group_cols, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counted = base.groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_c"))
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in [*group_cols, "_v"]]
    s = cut_to_files(counted.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                            .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    sizes = s.groupBy("_pid").agg(F.sum("_c").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a proven size bound, safe to broadcast
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    upto = F.sum("_c").over(Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return (s.withColumn("_upto", upto).join(F.broadcast(offsets), "_pid")
             .withColumn("_to", F.col("_off") + F.col("_upto") - 1).withColumn("_from", F.col("_to") - F.col("_c") + 1)
             .drop("_pid", "_at", "_off", "_upto"))


def group_quantiles(df: DataFrame, group_cols: list[str], value: str, probs: list[float],
                    prefix: str = "q") -> DataFrame:
    """Exact quantiles per group with linear interpolation (pandas ``quantile`` / ``percentile_cont``).

    Output: one row per group with columns ``{prefix}{int(p*100)}``. A null group is one.
    """
    s = _counted_positions(df, group_cols, value)
    bounds = s.groupBy(*group_cols).agg(F.min("_from").alias("_gfirst"), F.sum("_c").alias("_cnt"))
    j = join_null_safe(s, bounds, group_cols)
    out = []
    for p in probs:
        # ranks and fraction of the two neighbours; each is the value whose rank range holds it
        pos = (F.col("_cnt") - 1) * F.lit(p)
        lo, hi = F.col("_gfirst") + F.floor(pos), F.col("_gfirst") + F.ceil(pos)
        at_lo = F.max(F.when((F.col("_from") <= lo) & (lo <= F.col("_to")), F.col("_v")))
        at_hi = F.max(F.when((F.col("_from") <= hi) & (hi <= F.col("_to")), F.col("_v")))
        fraction = F.max(pos - F.floor(pos))
        out.append((at_lo + (at_hi - at_lo) * fraction).alias(f"{prefix}{int(round(p * 100))}"))
    return j.groupBy(*group_cols).agg(*out)


def group_median(df: DataFrame, group_cols: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group (mean of the two middle values; nulls ignored; a null group is one).

    Same result as ``percentile(value, 0.5)`` / pandas ``median``.
    """
    s = _counted_positions(df, group_cols, value)
    bounds = s.groupBy(*group_cols).agg(F.min("_from").alias("_gfirst"), F.sum("_c").alias("_cnt"))
    lo = F.col("_gfirst") + F.floor((F.col("_cnt") - 1) / 2)
    hi = F.col("_gfirst") + F.floor(F.col("_cnt") / 2)
    held = lambda rank: F.when((F.col("_from") <= rank) & (rank <= F.col("_to")), F.col("_v"))
    return (join_null_safe(s, bounds, group_cols).groupBy(*group_cols)
            .agg(((F.max(held(lo)) + F.max(held(hi))) / 2).alias(out)))


def global_index(df: DataFrame, order_cols: list, out: str = "idx") -> DataFrame:
    """0-based position of every row in ``order_cols`` order (a distributed zipWithIndex)."""
    return _positions(df, [], order_cols).withColumnRenamed("_gpos", out)
