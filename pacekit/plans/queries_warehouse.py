"""Registered warehouse queries (S6, S11-S18) and reports on the stored star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import adapters, warehouse as WH
from .catalog import register
from ..operators.history import add_group_zscore
from ..operators.state import extend_history
from .oracle import HISTORY_CTE, RACE_STATS_CTE, RESULTS_CTE, with_ctes
from .queries_cleaning import cleaned
from .oracle_model import model_sql
from .queries_model import _PREDICTED, _coarse, _coarse_sql, _features, _trained
from .queries_profiling import C as CLEANED_CTES
from . import profiling as PR
from . import star as ST

_ORDER = '"Date", racekey, source_file, "Position", "Nom"'


_LOADED: dict = {}


def _loaded(spark, sf, times=2):
    """The cleaned results loaded twice into a warehouse (the second load must add nothing): one per
    application and scale factor, whose tables the queries below read."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LOADED:
        root = WH.new_warehouse(spark)
        clean = PR.with_derived(cleaned(spark, sf)).drop("temps_clean")
        for _ in range(times):
            out = WH.load_star(spark, root, clean)
        _LOADED[key] = out | {"root": root}
    return _LOADED[key]


@register("dim_get_or_create", with_ctes(f"""
SELECT CAST(row_number() OVER (ORDER BY "Nom_clean") AS BIGINT) AS runner_id, "Nom_clean" AS name_clean,
       name_origin, sex
FROM (SELECT "Nom_clean", arg_min_null("Nom", ({_ORDER})) AS name_origin, arg_min_null("Sexe", ({_ORDER})) AS sex
      FROM dv GROUP BY "Nom_clean") q""", *CLEANED_CTES))
def dim_get_or_create(spark, sf):
    return _loaded(spark, sf)["dim_runner"]


@register("race_dim_load", with_ctes(f"""
SELECT CAST(row_number() OVER (ORDER BY racekey) AS BIGINT) AS race_id, racekey, name, distance, date, year
FROM (SELECT racekey, arg_min_null("NomCourse", ({_ORDER})) AS name, arg_min_null("Distance", ({_ORDER})) AS distance,
             arg_min_null("Date", ({_ORDER})) AS date, arg_min_null(year, ({_ORDER})) AS year
      FROM dv GROUP BY racekey) q""", *CLEANED_CTES), doubles=("distance",))
def race_dim_load(spark, sf):
    return _loaded(spark, sf)["dim_race"]


@register("fact_load", with_ctes(f"""
SELECT CAST(row_number() OVER (ORDER BY "Date", racekey, source_file, "Position", "Nom", runner_id) AS BIGINT) AS result_id,
       runner_id, race_id, "Position" AS position, "Position Catégorie" AS position_category, temps_sec AS time_sec,
       speed_kmh, "Categorie" AS category_seen, categorie_cleaned AS category_clean, source_file
FROM dv JOIN (SELECT "Nom_clean", CAST(row_number() OVER (ORDER BY "Nom_clean") AS BIGINT) AS runner_id
              FROM (SELECT DISTINCT "Nom_clean" FROM dv) a) r USING ("Nom_clean")
        JOIN (SELECT racekey, CAST(row_number() OVER (ORDER BY racekey) AS BIGINT) AS race_id
              FROM (SELECT DISTINCT racekey FROM dv) b) k USING (racekey)""", *CLEANED_CTES), doubles=("speed_kmh",))
def fact_load(spark, sf):
    return _loaded(spark, sf)["fact_results"]


@register("prediction_writeback", _coarse_sql(model_sql("""
SELECT CAST(row_number() OVER (ORDER BY f.source_result_id) AS BIGINT) AS analysis_id, f.source_result_id, pr.predicted_z,
       pr.predicted_performance_index, pr.predicted_speed_kmh, pr.predicted_time_sec, pr.abs_error_time_sec, pr.split,
       count(pr.predicted_z) OVER () AS updated_rows
FROM f LEFT JOIN pred pr USING (source_result_id)"""), *_PREDICTED))
def prediction_writeback(spark, sf):
    """Analysis table loaded (truncate-and-load, columns ensured), then predictions written back."""
    root = WH.new_warehouse(spark)
    WH.load_analysis(spark, root, _features(spark, sf))
    table, n = WH.write_back_predictions(spark, root, _trained(spark, sf)["predictions"])
    return _coarse(table.select("analysis_id", "source_result_id", *WH.PREDICTION_COLUMNS)
                        .withColumn("updated_rows", F.lit(n).cast("long")))


@register("evolved_table", with_ctes("""
SELECT result_id, runner_id, race_id, CASE WHEN race_id % 2 = 0 THEN time_sec END AS time_sec,
       CASE WHEN race_id % 2 = 0 THEN category END AS category, year FROM results""", RESULTS_CTE))
def evolved_table(spark, sf):
    """S17 + S6: a stored table loaded, given two more columns, and loaded again; old and new files read as one."""
    root, rows = WH.new_warehouse(spark), adapters.results(spark, sf, with_positions=False)
    odd, even = (rows.where(F.col("race_id") % 2 == k) for k in (1, 0))
    WH.write_table(odd.select("result_id", "runner_id", "race_id", "year"), root, "results", partition="year")
    WH.add_columns(spark, root, "results", {"time_sec": "int", "category": "string", "year": "int"})
    return WH.append_rows(spark, root, "results", even)


_STAR = f"""
star AS (
SELECT r.runner_id, k.race_id, "NomCourse" AS name, "Date" AS date, "Distance" AS distance, dv.year, temps_sec AS time_sec, speed_kmh,
       CAST(row_number() OVER (ORDER BY "Date", racekey, source_file, "Position", "Nom", runner_id) AS BIGINT) AS result_id
FROM dv JOIN (SELECT "Nom_clean", CAST(row_number() OVER (ORDER BY "Nom_clean") AS BIGINT) AS runner_id
              FROM (SELECT DISTINCT "Nom_clean" FROM dv) a) r USING ("Nom_clean")
        JOIN (SELECT racekey, CAST(row_number() OVER (ORDER BY racekey) AS BIGINT) AS race_id
              FROM (SELECT DISTINCT racekey FROM dv) b) k USING (racekey)),
dr AS (SELECT CAST(row_number() OVER (ORDER BY racekey) AS BIGINT) AS race_id, name, date, distance, year
       FROM (SELECT racekey, arg_min_null("NomCourse", ({_ORDER})) AS name, arg_min_null("Distance", ({_ORDER})) AS distance,
                    arg_min_null("Date", ({_ORDER})) AS date, arg_min_null(year, ({_ORDER})) AS year FROM dv GROUP BY racekey) q)"""


@register("star_overview", with_ctes("""
SELECT (SELECT count(DISTINCT runner_id) FROM star) AS runners, (SELECT count(DISTINCT race_id) FROM star) AS races, n AS results,
       (SELECT min(year) FROM dr) AS first_year, (SELECT max(year) FROM dr) AS last_year, total AS total_distance
FROM (SELECT count(*) AS n, sum(dr.distance) AS total FROM star JOIN dr ON star.race_id = dr.race_id) t""", *CLEANED_CTES, _STAR),
          doubles=("total_distance",))
def star_overview(spark, sf):
    """A1 on the stored tables."""
    return ST.overview(spark, _loaded(spark, sf)["root"])


@register("star_races_of_year", with_ctes("""
SELECT dr.race_id, dr.name, dr.date, dr.distance, s.n AS participants, s.v AS avg_speed, s.t / NULLIF(dr.distance, 0) AS avg_pace_sec_km
FROM dr JOIN (SELECT race_id, count(*) AS n, avg(speed_kmh) AS v, avg(time_sec) AS t FROM star GROUP BY race_id) s USING (race_id)
WHERE dr.year = (SELECT max(year) FROM dr)""", *CLEANED_CTES, _STAR), doubles=("distance", "avg_speed", "avg_pace_sec_km"))
def star_races_of_year(spark, sf):
    """A4 on the stored tables: the races of the latest year, from that year's partition alone."""
    return ST.races_of_year(spark, _loaded(spark, sf)["root"])


@register("star_runner_history", with_ctes("""
SELECT result_id, runner_id, race_id, row_number() OVER w - 1 AS prior_races, lag(speed_kmh) OVER w AS previous_speed,
       max(speed_kmh) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_best_speed
FROM star WINDOW w AS (PARTITION BY runner_id ORDER BY result_id)""", *CLEANED_CTES, _STAR), doubles=("previous_speed", "prior_best_speed"))
def star_runner_history(spark, sf):
    """What each runner did before, from the buckets of the fact table."""
    return ST.runner_history(spark, _loaded(spark, sf)["root"])


_HISTORY = ("prior_race_count", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z", "prior_std_z", "prior_best_z",
            "recent_speed_roll3", "recent_z_roll3", "days_since_last_race", "runner_history_years")


@register("history_in_waves", with_ctes(f"SELECT result_id, runner_id, {', '.join(_HISTORY)} FROM hist", RESULTS_CTE, RACE_STATS_CTE, HISTORY_CTE),
          doubles=_HISTORY[1:])
def history_in_waves(spark, sf):
    """W5-W11 from a stored state: each season's results are scored against one row per runner, which they then extend."""
    root, rows = WH.new_warehouse(spark), add_group_zscore(adapters.results(spark, sf, with_positions=False), median=False)
    out, seasons = None, ((None, 1996), (1996, 1997), (1997, None))
    for after, upto in seasons:
        wave = rows.where((F.lit(True) if after is None else F.col("year") > after) & (F.lit(True) if upto is None else F.col("year") <= upto))
        features, state = extend_history(wave, WH.read_table(spark, root, "runner_state"))
        features = features.select("result_id", "runner_id", *_HISTORY)
        out = WH.replace_table(spark, root, "features", features) if out is None else WH.append_rows(spark, root, "features", features)
        WH.replace_table(spark, root, "runner_state", state)
    return out
