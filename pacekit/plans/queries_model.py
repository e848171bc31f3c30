"""Registered model and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import adapters
from . import model as M
from . import reports as R
from . import scoring as S
from .catalog import register
from .features import build_features
from ..session import stage_table
from ..sources.tables import table
from .oracle import FEATURES_SQL, RESULTS_CTE, with_ctes
from .oracle_model import COEFFICIENTS, PROBE_Z, model_sql
from .sqlfmt import time_sql


def _features(spark, sf):
    """The feature table, a stage: the training, the analysis table and what reads both build it once."""
    return stage_table(spark, f"features:{sf}", lambda: build_features(adapters.results(spark, sf)))


@register("temporal_split", """
WITH f AS (""" + FEATURES_SQL + """)
SELECT source_result_id, year, CASE WHEN year = (SELECT max(year) FROM f) THEN 'test' ELSE 'train' END AS split
FROM f WHERE race_std_speed IS NOT NULL""")
def temporal_split(spark, sf):
    data = M.temporal_split(M.prepare_dataset(_features(spark, sf)))
    return data.select("source_result_id", "year", "split")


@register("baseline_quality", """
WITH f AS (""" + FEATURES_SQL + """),
s AS (SELECT *, CASE WHEN year = (SELECT max(year) FROM f) THEN 'test' ELSE 'train' END AS split,
             CAST(actual_time_sec AS DOUBLE) AS target_time_sec FROM f
      WHERE race_std_speed IS NOT NULL AND recent_z_roll3 IS NOT NULL),
p AS (SELECT *, CASE WHEN race_mean_speed + recent_z_roll3 * race_std_speed < 1 THEN 1.0::DOUBLE
                     ELSE race_mean_speed + recent_z_roll3 * race_std_speed END AS spd FROM s),
q AS (SELECT *, distance / NULLIF(spd, 0) * 3600.0::DOUBLE AS predicted_time_sec, recent_z_roll3 AS predicted_z FROM p),
m AS (SELECT split, avg(target_z) AS my FROM q GROUP BY split)
SELECT q.split, count(*) AS n, avg(abs(target_z - predicted_z)) AS mae_z, sqrt(avg((target_z - predicted_z) ^ 2)) AS rmse_z,
       1.0::DOUBLE - sum((target_z - predicted_z) ^ 2) / sum((target_z - m.my) ^ 2) AS r2_z,
       avg(abs(target_time_sec - predicted_time_sec)) AS mae_time_sec,
       sqrt(avg((target_time_sec - predicted_time_sec) ^ 2)) AS rmse_time_sec
FROM q JOIN m USING (split) GROUP BY q.split""",
          doubles=("mae_z", "rmse_z", "r2_z", "mae_time_sec", "rmse_time_sec"))
def baseline_quality(spark, sf):
    """A24 on a persistence forecast (predicted z = mean z of the last 3 races): metric operator with an oracle."""
    data = M.temporal_split(M.prepare_dataset(_features(spark, sf))).where(F.col("recent_z_roll3").isNotNull())
    pred = M.predict_time(data.withColumn("predicted_z", F.col("recent_z_roll3")))
    return M.regression_metrics(pred)


# One training run per application and scale factor: a job whose result the queries below share.
_TRAINED: dict = {}

# Digits to which a model's output is compared: Spark and SQL solve the fit in different orders.
_DIGITS = {"predicted_z": 5, "predicted_performance_index": 4, "predicted_speed_kmh": 4, "predicted_time_sec": 2,
           "predicted_pace_sec_km": 2, "abs_error_time_sec": 2, "time_gap_sec": 2, "index_gap": 4, "index_value": 4,
           "coefficient": 5, "abs_coefficient": 5, "mae_z": 5, "rmse_z": 5, "r2_z": 5, "mae_time_sec": 2, "rmse_time_sec": 2,
           "r2_z_gap": 5, "mae_time_sec_gap": 2, "actual_min": 4, "predicted_min": 4, "axis_min": 4, "axis_max": 4,
           "actual_z": 5, "expected_index": 4}


def _coarse(df):
    return df.select(*[(F.round(c, _DIGITS[c]) + F.lit(0.0)).alias(c) if c in _DIGITS else F.col(c) for c in df.columns])


def _coarse_sql(sql: str, *columns: str) -> str:
    rounded = ", ".join(f"round({c}, {_DIGITS[c]}) + 0.0::DOUBLE AS {c}" for c in columns)
    return f"SELECT * REPLACE ({rounded}) FROM (\n{sql}\n) _c"


def _trained(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = M.train(_features(spark, sf))
    return _TRAINED[key]


_METRICS = """
mm AS (SELECT split, count(*) AS n, avg(abs(target_z - predicted_z)) AS mae_z, sqrt(avg((target_z - predicted_z) ^ 2)) AS rmse_z,
              1.0::DOUBLE - sum((target_z - predicted_z) ^ 2) / (var_pop(target_z) * count(*)) AS r2_z,
              avg(abs_error_time_sec) AS mae_time_sec, sqrt(avg(abs_error_time_sec ^ 2)) AS rmse_time_sec
       FROM pred GROUP BY split)"""


@register("regression_quality", _coarse_sql(model_sql("""
SELECT mm.*, a.r2_z - b.r2_z AS r2_z_gap, b.mae_time_sec - a.mae_time_sec AS mae_time_sec_gap
FROM mm, mm a, mm b WHERE a.split = 'train' AND b.split = 'test'""", _METRICS),
                                            "mae_z", "rmse_z", "r2_z", "mae_time_sec", "rmse_time_sec", "r2_z_gap", "mae_time_sec_gap"))
def regression_quality(spark, sf):
    """A24 + A25 for the OLS model."""
    t = _trained(spark, sf)
    return _coarse(t["metrics"].crossJoin(t["gap"]))


@register("coefficients", _coarse_sql(model_sql(
    f"SELECT feature, coefficient, abs(coefficient) AS abs_coefficient FROM ({COEFFICIENTS}) q"), "coefficient", "abs_coefficient"))
def coefficients(spark, sf):
    """M7: top standardised coefficients."""
    t = _trained(spark, sf)
    n = t["predictions"].where(F.col("split") == "train").count()
    return _coarse(M.coefficients(t["model"], n_train=n))


_PREDICTED = ("predicted_z", "predicted_performance_index", "predicted_speed_kmh", "predicted_time_sec", "abs_error_time_sec")


@register("historical_predictions", _coarse_sql(model_sql("SELECT * FROM pred"), *_PREDICTED), doubles=("target_z",))
def historical_predictions(spark, sf):
    """M8: every train/test row with its prediction and split label."""
    return _coarse(_trained(spark, sf)["predictions"])


@register("actual_vs_predicted", _coarse_sql(model_sql("""
SELECT source_result_id, target_time_sec / 60 AS actual_min, predicted_time_sec / 60 AS predicted_min,
       least(min(target_time_sec) OVER (), min(predicted_time_sec) OVER ()) / 60 AS axis_min,
       greatest(max(target_time_sec) OVER (), max(predicted_time_sec) OVER ()) / 60 AS axis_max
FROM pred WHERE split = 'test'"""), "actual_min", "predicted_min", "axis_min", "axis_max"))
def actual_vs_predicted(spark, sf):
    """M10."""
    return _coarse(M.actual_vs_predicted(_trained(spark, sf)["predictions"]))


def _requests(spark, sf):
    """What-if requests, one per line item: its customer would run the race of the ship month."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("runner_id"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    month = ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("int")
    return orders.join(lines, "o_orderkey").select("runner_id", month.alias("race_id"))


_ASOF_SELECT = """
SELECT p.runner_id, p.race_id, ra.distance, CAST(month(ra.date) AS INTEGER) AS race_month,
       CAST(dayofyear(ra.date) AS INTEGER) AS race_dayofyear,
       CAST(count(h.result_id) AS INTEGER) AS prior_race_count,
       avg(h.speed_kmh) AS prior_avg_speed, stddev_samp(h.speed_kmh) AS prior_std_speed, max(h.speed_kmh) AS prior_best_speed,
       avg(h.z) AS prior_avg_z, stddev_samp(h.z) AS prior_std_z, max(h.z) AS prior_best_z,
       avg(h.speed_kmh) FILTER (WHERE h.rk <= 3) AS recent_speed_roll3, avg(h.z) FILTER (WHERE h.rk <= 3) AS recent_z_roll3,
       CAST(date_diff('day', max(h.date), ra.date) AS DOUBLE) AS days_since_last_race,
       date_diff('day', min(h.date), ra.date) / 365.25::DOUBLE AS runner_history_years
FROM probes p JOIN dim_race ra ON p.race_id = ra.race_id
LEFT JOIN LATERAL (
   SELECT v.*, row_number() OVER (ORDER BY v.date DESC, v.race_id DESC, v.result_id DESC) AS rk
   FROM valid v WHERE v.runner_id = p.runner_id AND v.date < ra.date) h ON true
GROUP BY p.runner_id, p.race_id, ra.distance, ra.date"""

_ASOF_CTES = """
rs AS (SELECT race_id, avg(speed_kmh) AS m, stddev_samp(speed_kmh) AS s FROM results GROUP BY race_id),
valid AS (SELECT r.*, (r.speed_kmh - rs.m) / NULLIF(rs.s, 0) AS z FROM results r JOIN rs USING (race_id)
          WHERE (r.speed_kmh - rs.m) / NULLIF(rs.s, 0) IS NOT NULL),
probes AS (SELECT DISTINCT o_custkey AS runner_id, CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INTEGER) AS race_id
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


@register("asof_history", with_ctes(_ASOF_SELECT, RESULTS_CTE, _ASOF_CTES),
          doubles=("distance", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z", "prior_std_z",
                   "prior_best_z", "recent_speed_roll3", "recent_z_roll3", "days_since_last_race",
                   "runner_history_years"))
def asof_history(spark, sf):
    fact = adapters.results(spark, sf, with_positions=False)
    return S.asof_features(fact, adapters.dim_race(spark, sf), _requests(spark, sf))


_ASOF_FEATURES = ("distance", "race_month", "race_dayofyear", "prior_race_count", "prior_avg_speed", "prior_std_speed", "prior_best_speed",
                  "prior_avg_z", "prior_std_z", "prior_best_z", "recent_speed_roll3", "recent_z_roll3", "days_since_last_race",
                  "runner_history_years")


@register("whatif_scoring", _coarse_sql(model_sql(f"""
SELECT *, 100.0::DOUBLE + 10.0::DOUBLE * predicted_z AS predicted_performance_index,
       distance / NULLIF(predicted_speed_kmh, 0) * 3600.0::DOUBLE AS predicted_time_sec,
       3600.0::DOUBLE / NULLIF(predicted_speed_kmh, 0) AS predicted_pace_sec_km
FROM (SELECT *, CASE WHEN race_mean_speed + predicted_z * race_std_speed < 1 THEN 1.0::DOUBLE
                     ELSE race_mean_speed + predicted_z * race_std_speed END AS predicted_speed_kmh
      FROM (SELECT q.*, CASE WHEN status = 'ok' THEN {PROBE_Z} END AS predicted_z
            FROM (SELECT p.runner_id, p.race_id, c.race_participants, c.race_mean_speed, c.race_std_speed,
                         {", ".join("h." + c for c in _ASOF_FEATURES)},
                         CASE WHEN ra.race_id IS NULL THEN 'race_not_found'
                              WHEN EXISTS (SELECT 1 FROM results r WHERE r.runner_id = p.runner_id AND r.race_id = p.race_id) THEN 'already_run'
                              WHEN c.race_std_speed IS NULL OR c.race_std_speed <= 0 THEN 'race_baseline_unreliable'
                              WHEN coalesce(h.prior_race_count, 0) < 3 THEN 'not_enough_history' ELSE 'ok' END AS status
                  FROM probes p LEFT JOIN dim_race ra ON p.race_id = ra.race_id
                  LEFT JOIN crowd c ON p.race_id = c.race_id
                  LEFT JOIN past h ON p.runner_id = h.runner_id AND p.race_id = h.race_id) q, beta, med, st) y) z""",
    RESULTS_CTE, _ASOF_CTES, f"past AS ({_ASOF_SELECT})", """
crowd AS (SELECT race_id, count(*) AS race_participants, avg(speed_kmh) AS race_mean_speed, stddev_samp(speed_kmh) AS race_std_speed
          FROM results GROUP BY race_id)"""),
    "predicted_z", "predicted_performance_index", "predicted_speed_kmh", "predicted_time_sec", "predicted_pace_sec_km"),
    doubles=("race_mean_speed", "race_std_speed", "distance", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z",
             "prior_std_z", "prior_best_z", "recent_speed_roll3", "recent_z_roll3", "days_since_last_race", "runner_history_years"))
def whatif_scoring(spark, sf):
    """M9: every requested (runner, race), scored when the guards pass."""
    fact = adapters.results(spark, sf, with_positions=False)
    t = _trained(spark, sf)
    return _coarse(S.whatif(fact, adapters.dim_race(spark, sf), _requests(spark, sf).distinct(), t["model"]))


_HISTORY = """
with_expected AS (SELECT r.runner_id, r.result_id, r.race_id, r.date,
         100.0::DOUBLE + 10.0::DOUBLE * ((r.speed_kmh - w.m) / NULLIF(w.s, 0)) AS performance_index,
         pr.predicted_performance_index, r.time_sec - pr.predicted_time_sec AS time_gap_sec, pr.predicted_time_sec, pr.predicted_z,
         100.0::DOUBLE + 10.0::DOUBLE * ((r.speed_kmh - w.m) / NULLIF(w.s, 0)) - pr.predicted_performance_index AS index_gap
  FROM results r JOIN (SELECT race_id, avg(speed_kmh) AS m, stddev_samp(speed_kmh) AS s FROM results GROUP BY race_id) w USING (race_id)
  LEFT JOIN pred pr ON r.runner_id = pr.runner_id AND r.race_id = pr.race_id)"""


@register("history_with_expected", _coarse_sql(model_sql("""
SELECT runner_id, result_id, race_id, date, performance_index, predicted_performance_index, time_gap_sec, index_gap,
       count(predicted_time_sec) OVER (PARTITION BY runner_id) > 0 AS has_expected FROM with_expected""", RESULTS_CTE, _HISTORY),
                                               "predicted_performance_index", "time_gap_sec", "index_gap"), doubles=("performance_index",))
def history_with_expected(spark, sf):
    """J3 + A27 + F23: each runner's results left-joined on (runner_id, race_id) to the stored
    predictions; gaps and a per-runner any-prediction flag."""
    return _coarse(_history_with_expected(spark, sf))


def _history_with_expected(spark, sf):
    fact = adapters.results(spark, sf)
    hist = R.runner_results(fact, adapters.dim_race(spark, sf))
    pred = _trained(spark, sf)["predictions"].select("runner_id", "race_id", "predicted_performance_index",
                                                     "predicted_time_sec", "predicted_z")
    j = hist.join(pred, ["runner_id", "race_id"], "left")
    j = (j.withColumn("time_gap_sec", F.col("time_sec") - F.col("predicted_time_sec"))
          .withColumn("index_gap", F.col("performance_index") - F.col("predicted_performance_index")))
    flag = j.groupBy("runner_id").agg((F.count("predicted_time_sec") > 0).alias("has_expected"))
    return j.join(flag, "runner_id").select("runner_id", "result_id", "race_id", "date", "performance_index",
                                            "predicted_performance_index", "time_gap_sec", "index_gap", "has_expected")


@register("expected_series", _coarse_sql(model_sql("""
SELECT runner_id, date, 'actual' AS series, performance_index AS index_value FROM with_expected
UNION ALL SELECT runner_id, date, 'expected', predicted_performance_index FROM with_expected WHERE predicted_performance_index IS NOT NULL""",
    RESULTS_CTE, _HISTORY), "index_value"))
def expected_series(spark, sf):
    """Actual and expected index as one labelled series (rows without an expected value
    dropped), unpivoted from one pass over the history."""
    h = _history_with_expected(spark, sf).select("runner_id", "date", F.col("performance_index").alias("actual"),
                                                 F.col("predicted_performance_index").alias("expected"))
    long_ = h.unpivot(["runner_id", "date"], ["actual", "expected"], "series", "index_value")
    return _coarse(long_.where((F.col("series") == "actual") | F.col("index_value").isNotNull()))


_RANK_COLUMNS = ("predicted_performance_index", "predicted_time_sec", "predicted_z")


@register("ranking_with_expected", _coarse_sql(model_sql(f"""
SELECT *, time_sec - predicted_time_sec AS time_gap_sec, predicted_performance_index - performance_index AS index_gap FROM (
SELECT f.result_id, f.runner_id, f.race_id, r.name_clean, f.position, f.time_sec,
       100.0::DOUBLE + 10.0::DOUBLE * ((f.speed_kmh - w.m) / NULLIF(w.s, 0)) AS performance_index,
       pr.target_z AS actual_z, pr.predicted_z, pr.predicted_performance_index, pr.predicted_time_sec,
       {time_sql('pr.predicted_time_sec')} AS predicted_time
FROM results f JOIN dim_runner r ON f.runner_id = r.runner_id
JOIN (SELECT race_id, avg(speed_kmh) AS m, stddev_samp(speed_kmh) AS s FROM results GROUP BY race_id) w ON f.race_id = w.race_id
LEFT JOIN (SELECT * FROM pred WHERE predicted_time_sec IS NOT NULL) pr ON f.runner_id = pr.runner_id AND f.race_id = pr.race_id) q""",
    RESULTS_CTE), "actual_z", "predicted_z", "predicted_performance_index", "predicted_time_sec", "time_gap_sec", "index_gap"),
    doubles=("performance_index",))
def ranking_with_expected(spark, sf):
    """Each race's ranking left-merged with the stored predictions that have a time, with the
    actual and predicted z and the gaps (F21/F23)."""
    from ..functions.format import format_time
    ranking = R.race_ranking(adapters.results(spark, sf), adapters.dim_race(spark, sf), adapters.dim_runner(spark, sf))
    pred = (_trained(spark, sf)["predictions"].where(F.col("predicted_time_sec").isNotNull())
            .withColumnRenamed("target_z", "actual_z"))
    out = R.with_expected(ranking, pred, cols=("actual_z", *_RANK_COLUMNS))
    return _coarse(out.select("result_id", "runner_id", "race_id", "name_clean", "position", "time_sec", "performance_index", "actual_z",
                              "predicted_z", "predicted_performance_index", "predicted_time_sec",
                              format_time("predicted_time_sec").alias("predicted_time"),
                              (F.col("time_sec") - F.col("predicted_time_sec")).alias("time_gap_sec"),
                              (F.col("predicted_performance_index") - F.col("performance_index")).alias("index_gap")))


@register("feature_fallbacks", """
WITH f AS (""" + FEATURES_SQL + """)
SELECT k.stored, source_result_id + k.add AS source_result_id, actual_time_sec + k.seconds AS target_time_sec, count(*) OVER (PARTITION BY k.stored) AS n
FROM f, (VALUES ('reference, actual time', 0, 0.0::DOUBLE), ('own id, actual time', 1, 0.0::DOUBLE), ('reference, time', 0, 1.0::DOUBLE),
                ('own id, target time', 1, 2.0::DOUBLE)) k(stored, add, seconds)
WHERE race_std_speed IS NOT NULL""", doubles=("target_time_sec",))
def feature_fallbacks(spark, sf):
    """Which stored column serves as reference and as time, for tables that have one or several of them."""
    base, one = _features(spark, sf), None
    own = (F.col("source_result_id") + 1).alias("result_id")
    shapes = {"reference, actual time": base, "own id, actual time": base.select("*", own),
              "reference, time": base.withColumn("time_sec", F.col("actual_time_sec") + 1),
              "own id, target time": base.select("*", own, (F.col("actual_time_sec") + 1).alias("time_sec"), (F.col("actual_time_sec") + 2).alias("target_time_sec"))}
    for name, shape in shapes.items():
        rows = M.prepare_dataset(shape).select(F.lit(name).alias("stored"), "source_result_id", "target_time_sec")
        one = rows if one is None else one.unionByName(rows)
    return one.join(one.groupBy("stored").agg(F.count(F.lit(1)).alias("n")), "stored")
