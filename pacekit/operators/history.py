"""Per-group normalisation and leakage-free per-entity history features.

All entity windows share ONE window spec (same partition and order), so Spark
plans one shuffle by entity and one sort for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe
from .ranking import group_median


def group_stats(df: DataFrame, group: str = "race_id", value: str = "speed_kmh",
                entity: str = "runner_id", median: bool = True) -> DataFrame:
    """Per group count of entity ids, mean, sample std and exact median of ``value``.

    Aggregations (map-side combined) instead of whole-partition windows; the
    median uses the skew-safe rank operator.
    """
    stats = df.groupBy(group).agg(
        F.count(entity).cast("int").alias("race_participants"),
        F.avg(value).alias("race_mean_speed"),
        F.stddev_samp(value).alias("race_std_speed"))
    if median:
        med = group_median(df, [group], value, "race_median_speed")
        stats = join_null_safe(stats, med, [group], "left")
    return stats


def add_group_zscore(df: DataFrame, group: str = "race_id", value: str = "speed_kmh",
                     entity: str = "runner_id", median: bool = True) -> DataFrame:
    """Attach group stats, z-score (zero std -> null) and 100 + 10 z."""
    stats = group_stats(df, group, value, entity, median)
    out = join_null_safe(df, stats, [group])
    z = (F.col(value) - F.col("race_mean_speed")) / F.nullif(F.col("race_std_speed"), F.lit(0.0))
    return (out.withColumn("speed_z_race", z)
               .withColumn("performance_index", F.lit(100.0) + F.lit(10.0) * F.col("speed_z_race")))


def entity_window(entity: str = "runner_id", time: str = "date", event: str = "race_id",
                  tiebreak: str = "result_id"):
    """Order of an entity's history: time (nulls last), event, then a unique tie-break."""
    return Window.partitionBy(entity).orderBy(F.col(time).asc_nulls_last(), F.col(event), F.col(tiebreak))


def add_history(df: DataFrame, entity: str = "runner_id", time: str = "date", event: str = "race_id",
                tiebreak: str = "result_id", speed: str = "speed_kmh", z: str = "speed_z_race",
                segmented: bool = True) -> DataFrame:
    """W5-W11 (see :func:`add_history_windows`).

    Default: entities of many rows take the segmented prefix scan (``operators.prefix``), which spreads
    them over many tasks, all others a window; ``segmented=False`` uses one window for every entity.
    """
    if segmented:
        from .prefix import add_history_split
        return add_history_split(df, entity, time, event, tiebreak, speed, z)
    return add_history_windows(df, entity, time, event, tiebreak, speed, z)


def add_history_windows(df: DataFrame, entity: str = "runner_id", time: str = "date", event: str = "race_id",
                        tiebreak: str = "result_id", speed: str = "speed_kmh", z: str = "speed_z_race") -> DataFrame:
    """Features from strictly earlier rows of the same entity.

    prior_race_count   rows before (0-based cumcount, null z rows included)
    prior_{avg,std,best}_{speed,z}   expanding mean / sample std / max over earlier rows
    recent_{speed,z}_roll3           mean of the (up to) 3 previous rows, nulls skipped
    days_since_last_race             days since the previous row's date
    runner_history_years             (date - first date of the entity) / 365.25
    """
    w = entity_window(entity, time, event, tiebreak)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    last3 = w.rowsBetween(-3, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*",
        (F.row_number().over(w) - 1).cast("int").alias("prior_race_count"),
        F.avg(speed).over(past).alias("prior_avg_speed"),
        F.stddev_samp(speed).over(past).alias("prior_std_speed"),
        F.max(speed).over(past).alias("prior_best_speed"),
        F.avg(z).over(past).alias("prior_avg_z"),
        F.stddev_samp(z).over(past).alias("prior_std_z"),
        F.max(z).over(past).alias("prior_best_z"),
        F.avg(speed).over(last3).alias("recent_speed_roll3"),
        F.avg(z).over(last3).alias("recent_z_roll3"),
        F.datediff(F.col(time), F.lag(time).over(w)).cast("double").alias("days_since_last_race"),
        (F.datediff(F.col(time), F.min(time).over(whole)) / F.lit(365.25)).alias("runner_history_years"),
    )
