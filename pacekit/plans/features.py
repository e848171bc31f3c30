"""Feature job: results -> race normalisation -> runner history -> model table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import add_group_zscore, add_history
from ..functions.numeric import nan_to_null

FEATURE_COLUMNS = [
    "source_result_id", "runner_id", "race_id", "date", "year", "distance",
    "actual_position", "actual_position_category", "actual_time_sec", "actual_speed_kmh",
    "race_month", "race_dayofyear", "race_participants", "race_mean_speed", "race_std_speed",
    "race_median_speed", "prior_race_count", "prior_avg_speed", "prior_std_speed", "prior_best_speed",
    "prior_avg_z", "prior_std_z", "prior_best_z", "recent_speed_roll3", "recent_z_roll3",
    "days_since_last_race", "runner_history_years", "speed_z_race", "performance_index", "target_z",
]


def build_features(results: DataFrame, min_history: int | None = 2, median: bool = True) -> DataFrame:
    """P12-P14 on top of W1-W11.

    ``results`` needs result_id, runner_id, race_id, date, distance, time_sec,
    speed_kmh, position, position_category.  Rows are kept when the runner has
    at least ``min_history`` earlier results and the target z is defined
    (``min_history=None`` keeps every row).
    """
    df = add_group_zscore(results, median=median)
    df = add_history(df)
    df = df.select(
        F.col("result_id").alias("source_result_id"), "*",
        F.month("date").alias("race_month"),
        F.dayofyear("date").alias("race_dayofyear"),
        F.col("position").alias("actual_position"),
        F.col("position_category").alias("actual_position_category"),
        F.col("time_sec").cast("double").alias("actual_time_sec"),
        F.col("speed_kmh").alias("actual_speed_kmh"),
        F.col("speed_z_race").alias("target_z"),
    )
    df = nan_to_null(df)
    if min_history is not None:
        df = df.where((F.col("prior_race_count") >= min_history) & F.col("target_z").isNotNull())
    return df.select(*[c for c in FEATURE_COLUMNS if c in df.columns] if median
                     else [c for c in FEATURE_COLUMNS if c != "race_median_speed"])
