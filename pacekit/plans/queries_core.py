"""Registered queries: race normalisation, history features, dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.history import add_group_zscore, add_history, group_stats
from ..sources import adapters
from .catalog import register
from .features import build_features
from .oracle import FEATURES_SQL, HISTORY_CTE, RACE_STATS_CTE, RESULTS_CTE, with_ctes


@register("race_zscore", with_ctes("""
SELECT result_id, race_id, race_participants, race_mean_speed, race_std_speed, speed_z_race, performance_index
FROM zres""", RESULTS_CTE, RACE_STATS_CTE),
          doubles=("race_mean_speed", "race_std_speed", "speed_z_race", "performance_index"))
def race_zscore(spark, sf_dir):
    r = adapters.results(spark, sf_dir, with_positions=False)
    return add_group_zscore(r, median=False).select(
        "result_id", "race_id", "race_participants", "race_mean_speed", "race_std_speed",
        "speed_z_race", "performance_index")


@register("race_median", with_ctes("""
SELECT race_id, race_median_speed FROM race_stats""", RESULTS_CTE, RACE_STATS_CTE),
          doubles=("race_median_speed",))
def race_median(spark, sf_dir):
    r = adapters.results(spark, sf_dir, with_positions=False)
    return group_stats(r).select("race_id", "race_median_speed")


_HIST_COLS = ("prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z", "prior_std_z", "prior_best_z")


def _history(spark, sf_dir):
    r = adapters.results(spark, sf_dir, with_positions=False)
    return add_history(add_group_zscore(r, median=False))


@register("runner_history", with_ctes("""
SELECT result_id, runner_id, prior_race_count, """ + ", ".join(_HIST_COLS) + """ FROM hist""",
                                      RESULTS_CTE, RACE_STATS_CTE, HISTORY_CTE), doubles=_HIST_COLS)
def runner_history(spark, sf_dir):
    return _history(spark, sf_dir).select("result_id", "runner_id", "prior_race_count", *_HIST_COLS)


@register("recent_form", with_ctes("""
SELECT result_id, runner_id, recent_speed_roll3, recent_z_roll3 FROM hist""",
                                   RESULTS_CTE, RACE_STATS_CTE, HISTORY_CTE),
          doubles=("recent_speed_roll3", "recent_z_roll3"))
def recent_form(spark, sf_dir):
    return _history(spark, sf_dir).select("result_id", "runner_id", "recent_speed_roll3", "recent_z_roll3")


@register("recency", with_ctes("""
SELECT result_id, runner_id, days_since_last_race, runner_history_years FROM hist""",
                               RESULTS_CTE, RACE_STATS_CTE, HISTORY_CTE),
          doubles=("days_since_last_race", "runner_history_years"))
def recency(spark, sf_dir):
    return _history(spark, sf_dir).select("result_id", "runner_id", "days_since_last_race", "runner_history_years")


_FEAT_DOUBLES = ("distance", "actual_time_sec", "actual_speed_kmh", "race_mean_speed", "race_std_speed",
                 "race_median_speed", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z",
                 "prior_std_z", "prior_best_z", "recent_speed_roll3", "recent_z_roll3", "days_since_last_race",
                 "runner_history_years", "speed_z_race", "performance_index", "target_z")


@register("feature_table", FEATURES_SQL, doubles=_FEAT_DOUBLES)
def feature_table(spark, sf_dir):
    return build_features(adapters.results(spark, sf_dir))


@register("dedup_first", with_ctes("""
SELECT runner_id, race_id, result_id, category FROM _d""", RESULTS_CTE))
def dedup_first(spark, sf_dir):
    r = adapters.base_results(spark, sf_dir)
    return r.select("runner_id", "race_id", "result_id", "category")
