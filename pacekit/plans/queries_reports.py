"""Registered report queries."""

from __future__ import annotations

from ..sources import adapters
from . import reports as R
from .catalog import register
from .oracle import RESULTS_CTE, with_ctes
from .sqlfmt import pace_sql, signed_sql, speed_label_sql, time_sql

FR = "results f JOIN dim_race ra ON f.race_id = ra.race_id"
# each race's crowd
RS = "race_stats AS (SELECT race_id, avg(speed_kmh) AS race_mean_speed, stddev_samp(speed_kmh) AS race_std_speed FROM results GROUP BY race_id)"
# results carry their race's year and distance: a race is a row of its results
_BY_RACE = """by_race AS (SELECT race_id, 'Course ' || race_id AS name, min(date) AS date, min(year) AS year, min(distance) AS distance, count(*) AS n,
  sum(speed_kmh) AS v, stddev_samp(speed_kmh) AS sd, sum(time_sec / NULLIF(distance, 0)) AS p FROM results GROUP BY race_id)"""


def _fact(spark, sf, pos=False):
    return adapters.results(spark, sf, with_positions=pos)


@register("kpi_overview", with_ctes("""
SELECT (SELECT count(*) FROM (SELECT DISTINCT runner_id FROM results) u) AS runners, count(*) AS races, sum(n)::BIGINT AS results,
       min(year) AS first_year, max(year) AS last_year, sum(n * distance) AS total_distance
FROM by_race""", RESULTS_CTE, _BY_RACE), doubles=("total_distance",))
def kpi_overview(spark, sf):
    return R.kpi_overview(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("yearly_trend", with_ctes(f"""
SELECT y.*, u.runners, CASE WHEN year = max(year) OVER () THEN 'selected' ELSE 'other' END AS year_status, {pace_sql('avg_pace_sec_km')} AS avg_pace
FROM (SELECT year, count(*) AS races, sum(n)::BIGINT AS results, sum(v) / sum(n) AS avg_speed, sum(p) / sum(n) AS avg_pace_sec_km
      FROM by_race GROUP BY year) y
JOIN (SELECT year, count(*) AS runners FROM (SELECT DISTINCT year, runner_id FROM results) w GROUP BY year) u USING (year)""", RESULTS_CTE, _BY_RACE),
          doubles=("avg_speed", "avg_pace_sec_km"))
def yearly_trend(spark, sf):
    return R.yearly_trend(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("races_of_year", with_ctes("""
SELECT race_id, name, date, distance, n AS participants, v / n AS avg_speed, p / n AS avg_pace_sec_km
FROM by_race QUALIFY year = max(year) OVER ()""", RESULTS_CTE, _BY_RACE), doubles=("distance", "avg_speed", "avg_pace_sec_km"))
def races_of_year(spark, sf):
    return R.races_of_year(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("race_profile", with_ctes("""
SELECT race_id, name, year, distance, n AS participants, v / n AS avg_speed, p / n AS avg_pace_sec_km, sd AS speed_std FROM by_race""",
                                    RESULTS_CTE, _BY_RACE), doubles=("distance", "avg_speed", "avg_pace_sec_km", "speed_std"))
def race_profile(spark, sf):
    return R.race_profile(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("race_ranking", with_ctes(f"""
SELECT *, {pace_sql('pace_sec_km')} AS pace,
       CASE WHEN performance_index > 101 THEN 'above' WHEN performance_index < 99 THEN 'below' ELSE 'near' END AS verdict
FROM (SELECT f.result_id, f.runner_id, f.race_id, r.name_clean, f.position, f.position_category, f.time_sec,
             f.speed_kmh, f.category AS category_clean,
             100.0::DOUBLE + 10.0::DOUBLE * ((f.speed_kmh - rs.race_mean_speed) / NULLIF(rs.race_std_speed, 0)) AS performance_index,
             {time_sql('f.time_sec')} AS time, f.time_sec / NULLIF(ra.distance, 0) AS pace_sec_km,
             coalesce(f.category, 'Non renseignée') AS category_label
      FROM {FR} JOIN dim_runner r ON f.runner_id = r.runner_id JOIN race_stats rs ON f.race_id = rs.race_id) q
""", RESULTS_CTE, RS), doubles=("speed_kmh", "performance_index", "pace_sec_km"))
def race_ranking(spark, sf):
    return R.race_ranking(_fact(spark, sf, pos=True), adapters.dim_race(spark, sf), adapters.dim_runner(spark, sf))


@register("top_runners", with_ctes("""
SELECT name_clean, races, total / races AS avg_speed, best_speed
FROM (SELECT upper(c.c_name) AS name_clean, sum(t.races)::BIGINT AS races, sum(t.total) AS total, max(t.best) AS best_speed
      FROM (SELECT runner_id, count(*) AS races, sum(speed_kmh) AS total, max(speed_kmh) AS best FROM results GROUP BY runner_id) t
      JOIN customer c ON c.c_custkey = t.runner_id GROUP BY 1) n
QUALIFY row_number() OVER (ORDER BY races DESC, name_clean) <= 20""", RESULTS_CTE),
          doubles=("avg_speed", "best_speed"))
def top_runners(spark, sf):
    return R.top_runners(_fact(spark, sf), adapters.dim_runner(spark, sf))


@register("top_races", with_ctes("""
SELECT 'Course ' || race_id AS name, year, distance, participants, total / participants AS avg_speed
FROM (SELECT race_id, year, distance, count(*) AS participants, sum(speed_kmh) AS total FROM results GROUP BY ALL)
QUALIFY row_number() OVER (ORDER BY participants DESC, 'Course ' || race_id, year, distance) <= 20""", RESULTS_CTE),
          doubles=("distance", "avg_speed"))
def top_races(spark, sf):
    return R.top_races(_fact(spark, sf), adapters.dim_race(spark, sf))


_CAT = f"""cat AS (SELECT f.*, coalesce(f.category, 'Non renseignée') AS category_label,
  f.time_sec / NULLIF(ra.distance, 0) AS pace_sec_km FROM {FR})"""


@register("category_counts", with_ctes(f"""
SELECT *, {pace_sql('mean_pace_sec_km')} AS mean_pace FROM (
  SELECT race_id, category_label, count(result_id) AS participants, avg(pace_sec_km) AS mean_pace_sec_km,
         avg(speed_kmh) AS mean_speed_kmh,
         CAST(row_number() OVER (PARTITION BY race_id ORDER BY count(result_id) DESC, category_label) AS INTEGER) AS rank
  FROM cat GROUP BY race_id, category_label) q WHERE rank <= 12""", RESULTS_CTE, _CAT),
          doubles=("mean_pace_sec_km", "mean_speed_kmh"))
def category_counts(spark, sf):
    return R.category_counts(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("category_summary", with_ctes(f"""
SELECT *, {time_sql('best_time_sec')} AS best_time, {time_sql('mean_time_sec')} AS mean_time,
       {time_sql('median_time_sec')} AS median_time, {pace_sql('mean_pace_sec_km')} AS mean_pace,
       {speed_label_sql('mean_speed_kmh')} AS mean_speed
FROM (SELECT race_id, category_label, count(result_id) AS participants, min(time_sec) AS best_time_sec,
             avg(time_sec) AS mean_time_sec, avg(pace_sec_km) AS mean_pace_sec_km, avg(speed_kmh) AS mean_speed_kmh,
             median(time_sec)::DOUBLE AS median_time_sec
      FROM cat GROUP BY race_id, category_label) q""", RESULTS_CTE, _CAT),
          doubles=("mean_time_sec", "mean_pace_sec_km", "mean_speed_kmh", "median_time_sec"))
def category_summary(spark, sf):
    return R.category_summary(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("race_header", with_ctes(f"""
SELECT race_id, participants, mean_time_sec, mean_pace_sec_km, mean_speed_kmh,
       printf('%s - %d (%.2f km)', name, year, distance) AS label,
       replace(format('{{:,}}', participants), ',', ' ') AS participants_label,
       {time_sql('mean_time_sec')} AS mean_time, {pace_sql('mean_pace_sec_km')} AS mean_pace,
       {speed_label_sql('mean_speed_kmh')} AS mean_speed
FROM (SELECT ra.race_id, ra.name, ra.year, ra.distance, count(*) AS participants, avg(f.time_sec) AS mean_time_sec,
             avg(f.time_sec / NULLIF(ra.distance, 0)) AS mean_pace_sec_km, avg(f.speed_kmh) AS mean_speed_kmh
      FROM {FR} GROUP BY ra.race_id, ra.name, ra.year, ra.distance) q""", RESULTS_CTE),
          doubles=("mean_time_sec", "mean_pace_sec_km", "mean_speed_kmh"))
def race_header(spark, sf):
    return R.race_header(_fact(spark, sf), adapters.dim_race(spark, sf))


_HIST = f"""h AS (SELECT f.*, ra.name, ra.year, ra.distance, ra.date,
  (f.speed_kmh - rs.race_mean_speed) / NULLIF(rs.race_std_speed, 0) AS speed_z_race,
  100.0::DOUBLE + 10.0::DOUBLE * ((f.speed_kmh - rs.race_mean_speed) / NULLIF(rs.race_std_speed, 0)) AS performance_index
  FROM {FR} JOIN race_stats rs ON f.race_id = rs.race_id)"""


@register("runner_header", with_ctes("""
SELECT runner_id, count(*) AS races, sum(distance) AS total_distance,
       avg(time_sec / NULLIF(distance, 0)) AS avg_pace_sec_km, avg(performance_index) AS avg_index
FROM h GROUP BY runner_id""", RESULTS_CTE, RS, _HIST), doubles=("total_distance", "avg_pace_sec_km", "avg_index"))
def runner_header(spark, sf):
    return R.runner_header(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("best_performance", with_ctes(f"""
SELECT runner_id, result_id, name, year, distance, time_sec, performance_index, {time_sql('time_sec')} AS time
FROM h WHERE performance_index IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY runner_id ORDER BY performance_index DESC, date, result_id) = 1""",
                                        RESULTS_CTE, RS, _HIST), doubles=("distance", "performance_index"))
def best_performance(spark, sf):
    return R.best_performance(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("axis_domain", with_ctes("""
SELECT runner_id, lo - greatest(1.0::DOUBLE, (hi - lo) * 0.08::DOUBLE) AS domain_min,
       hi + greatest(1.0::DOUBLE, (hi - lo) * 0.08::DOUBLE) AS domain_max
FROM (SELECT runner_id, least(coalesce(min(performance_index), 100.0), 100.0)::DOUBLE AS lo,
             greatest(coalesce(max(performance_index), 100.0), 100.0)::DOUBLE AS hi
      FROM h GROUP BY runner_id) q""", RESULTS_CTE, RS, _HIST), doubles=("domain_min", "domain_max"))
def axis_domain(spark, sf):
    return R.axis_domain(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("not_run_races", with_ctes("""
SELECT q.runner_id, q.race_id, d.name, d.year, d.distance
FROM (SELECT DISTINCT o_custkey AS runner_id, CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INTEGER) AS race_id
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey) q JOIN dim_race d USING (race_id)
ANTI JOIN results ran ON ran.runner_id = q.runner_id AND ran.race_id = q.race_id""", RESULTS_CTE), doubles=("distance",))
def not_run_races(spark, sf):
    """Of the races that runners ask for, those that they have not run."""
    from .queries_model import _requests
    return R.not_run_requests(_fact(spark, sf), adapters.dim_race(spark, sf), _requests(spark, sf))


@register("recent_years", with_ctes("""
SELECT DISTINCT year FROM dim_race ORDER BY year DESC LIMIT 3""", RESULTS_CTE))
def recent_years(spark, sf):
    return R.recent_years(adapters.dim_race(spark, sf))


@register("period_bounds", with_ctes(f"""
SELECT f.runner_id, min(ra.date) AS first_date, max(ra.date) AS last_date FROM {FR} GROUP BY f.runner_id""",
                                     RESULTS_CTE))
def period_bounds(spark, sf):
    return R.period_bounds(_fact(spark, sf), adapters.dim_race(spark, sf))


@register("pace_format", with_ctes(f"""
SELECT f.result_id, {time_sql('f.time_sec')} AS time, {pace_sql('f.time_sec / NULLIF(ra.distance, 0)')} AS pace,
       {signed_sql('f.time_sec - m.race_mean_time')} AS gap, {speed_label_sql('f.speed_kmh')} AS speed,
       coalesce(CAST(f.position AS VARCHAR), '') AS position_label
FROM {FR} JOIN (SELECT race_id, avg(time_sec) AS race_mean_time FROM results GROUP BY race_id) m
  ON f.race_id = m.race_id""", RESULTS_CTE))
def pace_format(spark, sf):
    return R.pace_formats(_fact(spark, sf, pos=True), adapters.dim_race(spark, sf))
