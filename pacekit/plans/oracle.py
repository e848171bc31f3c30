"""DuckDB twins of the registered queries (independent SQL oracle).

``RESULTS_CTE`` re-derives the results fact from ``orders`` in plain SQL,
without any of the Spark code paths, so each query's oracle is self-contained.
"""

from __future__ import annotations

# -- results adapter (see pacekit.sources.adapters) ---------------------------
RESULTS_CTE = """
_o AS (
  SELECT o_orderkey AS result_id, o_custkey AS runner_id,
         CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS race_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         o_totalprice, o_orderpriority AS category
  FROM orders),
_d AS (SELECT * FROM _o QUALIFY row_number() OVER (PARTITION BY runner_id, race_id ORDER BY result_id) = 1),
_r0 AS (SELECT result_id, runner_id, race_id, date, category, CAST(year(date) AS INTEGER) AS year,
               CAST(5.0 AS DOUBLE) + (race_id % 16) AS distance, o_totalprice FROM _d),
_r1 AS (SELECT *, CAST(floor(distance / (6.0::DOUBLE + o_totalprice / 50000.0::DOUBLE) * 3600.0::DOUBLE) AS INTEGER) AS time_sec
        FROM _r0),
results AS (
  SELECT result_id, runner_id, race_id, date, year, distance, time_sec,
         distance / (time_sec / 3600.0::DOUBLE) AS speed_kmh, category,
         CAST(row_number() OVER (PARTITION BY race_id ORDER BY time_sec, result_id) AS INTEGER) AS position,
         CAST(row_number() OVER (PARTITION BY race_id, category ORDER BY time_sec, result_id) AS INTEGER) AS position_category
  FROM _r1),
dim_race AS (
  SELECT race_id,
         concat_ws('_', lower(trim('Course ' || CAST(race_id AS VARCHAR))), CAST(min(date) AS VARCHAR),
                   CAST(min(distance) AS VARCHAR)) AS racekey,
         'Course ' || CAST(race_id AS VARCHAR) AS name, min(distance) AS distance, min(date) AS date,
         CAST(year(min(date)) AS INTEGER) AS year
  FROM results GROUP BY race_id),
dim_runner AS (
  SELECT c_custkey AS runner_id, c_name AS name_origin, upper(c_name) AS name_clean,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex
  FROM customer)
"""

RACE_STATS_CTE = """
race_stats AS (
  SELECT race_id, CAST(count(runner_id) AS INTEGER) AS race_participants,
         avg(speed_kmh) AS race_mean_speed, stddev_samp(speed_kmh) AS race_std_speed,
         median(speed_kmh) AS race_median_speed
  FROM results GROUP BY race_id),
zres AS (
  SELECT r.*, s.race_participants, s.race_mean_speed, s.race_std_speed, s.race_median_speed,
         (r.speed_kmh - s.race_mean_speed) / NULLIF(s.race_std_speed, 0) AS speed_z_race,
         100.0::DOUBLE + 10.0::DOUBLE * ((r.speed_kmh - s.race_mean_speed) / NULLIF(s.race_std_speed, 0)) AS performance_index
  FROM results r JOIN race_stats s USING (race_id))
"""

HISTORY_CTE = """
hist AS (
  SELECT *,
    CAST(row_number() OVER w - 1 AS INTEGER) AS prior_race_count,
    avg(speed_kmh) OVER wp AS prior_avg_speed,
    stddev_samp(speed_kmh) OVER wp AS prior_std_speed,
    max(speed_kmh) OVER wp AS prior_best_speed,
    avg(speed_z_race) OVER wp AS prior_avg_z,
    stddev_samp(speed_z_race) OVER wp AS prior_std_z,
    max(speed_z_race) OVER wp AS prior_best_z,
    avg(speed_kmh) OVER w3 AS recent_speed_roll3,
    avg(speed_z_race) OVER w3 AS recent_z_roll3,
    CAST(date_diff('day', lag(date) OVER w, date) AS DOUBLE) AS days_since_last_race,
    date_diff('day', min(date) OVER (PARTITION BY runner_id), date) / 365.25::DOUBLE AS runner_history_years
  FROM zres
  WINDOW w AS (PARTITION BY runner_id ORDER BY date ASC NULLS LAST, race_id, result_id),
         wp AS (PARTITION BY runner_id ORDER BY date ASC NULLS LAST, race_id, result_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         w3 AS (PARTITION BY runner_id ORDER BY date ASC NULLS LAST, race_id, result_id
                ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


FEATURES_SQL = with_ctes("""
SELECT result_id AS source_result_id, runner_id, race_id, date, year, distance,
       position AS actual_position, position_category AS actual_position_category,
       CAST(time_sec AS DOUBLE) AS actual_time_sec, speed_kmh AS actual_speed_kmh,
       CAST(month(date) AS INTEGER) AS race_month, CAST(dayofyear(date) AS INTEGER) AS race_dayofyear,
       race_participants, race_mean_speed, race_std_speed, race_median_speed,
       prior_race_count, prior_avg_speed, prior_std_speed, prior_best_speed,
       prior_avg_z, prior_std_z, prior_best_z, recent_speed_roll3, recent_z_roll3,
       days_since_last_race, runner_history_years, speed_z_race, performance_index,
       speed_z_race AS target_z
FROM hist WHERE prior_race_count >= 2 AND speed_z_race IS NOT NULL
""", RESULTS_CTE, RACE_STATS_CTE, HISTORY_CTE)


RAW_CTE = """
_raw0 AS (
  SELECT f.*, p.p_name, p.p_type, c.c_mktsegment, concat_ws(' ', p.p_name, p.p_type) AS base,
         f.time_sec // 3600 AS th, (f.time_sec % 3600) // 60 AS tm, f.time_sec % 60 AS ts
  FROM results f LEFT JOIN part p ON p.p_partkey = f.runner_id LEFT JOIN customer c ON c.c_custkey = f.runner_id),
raw_results AS (
  SELECT CASE WHEN result_id % 127 = 0 THEN 'DNF' ELSE CAST(position AS VARCHAR) END AS "Position",
    CASE WHEN result_id % 101 = 0 THEN '#N/A'
         WHEN result_id % 103 = 0 THEN CAST(result_id % 10 AS VARCHAR) || ' ' || base
         WHEN result_id % 107 = 0 THEN '(Cid:10)' || base
         WHEN result_id % 109 = 0 THEN NULL
         WHEN result_id % 5 = 1 THEN base || '  '
         ELSE base END AS "Nom",
    CASE WHEN result_id % 2 = 0 THEN c_mktsegment WHEN result_id % 3 = 0 THEN '*' ELSE '-' END AS "Club",
    CASE WHEN result_id % 113 = 0 THEN NULL WHEN runner_id % 2 = 0 THEN 'H' ELSE 'F' END AS "Sexe",
    ['', '#N/A', '#REF!', 'xxx', 'XXX', '0', 'A1', 'AI1', 'V1F', 'A2', 'AI2', 'V2F', 'A3', 'AI3', 'V3F', 'A4', 'AI4', 'V4F', 'A5', 'AI5', 'V45', 'SH', 'H', 'SEH', 'SEN', 'DISH', 'SE', 'JUH', 'JH', 'EH', 'ESH', 'ESP', 'GAR', 'DA', 'DAM', 'SD', 'F', 'SEF', 'DISF', 'JUF', 'JF', 'EF', 'ESF', 'FIL', 'ED', 'V1', 'VE1', 'V1H', 'V2', 'VE2', 'V2H', 'V3', 'VE3', 'V3H', 'V4', 'VE4', 'V4H', 'V5', 'VE5', 'V5H', 'ZZZ', NULL][CAST(result_id % 62 AS INTEGER) + 1] AS "Categorie",
    CAST(position_category AS VARCHAR) AS "Position Catégorie",
    CASE WHEN result_id % 89 = 0 THEN '#VALEUR!' WHEN result_id % 83 = 0 THEN NULL
         WHEN result_id % 79 = 0 THEN printf('%d: %02d:%02d', th, tm, ts)
         WHEN result_id % 73 = 0 THEN '1:2:3:4' WHEN result_id % 71 = 0 THEN 'ab:cd'
         WHEN th > 0 THEN printf('%d:%02d:%02d', th, tm, ts) ELSE printf('%02d:%02d', tm, ts) END AS "Temps",
    CASE WHEN race_id % 40 = 0 THEN 'Sef : ' || CAST(race_id AS VARCHAR) || ' Seh : 0'
         ELSE 'Course ' || CAST(race_id AS VARCHAR) END AS "NomCourse",
    date AS "Date", distance AS "Distance",
    strftime(date, '%Y%m%d') || '-race-' || CAST(race_id AS VARCHAR) || '.pdf' AS source_file
  FROM _raw0),
raw_keyed AS (
  SELECT *, lower(trim("NomCourse")) || '_' || coalesce(strftime("Date", '%Y-%m-%d'), 'NaT') || '_' || CAST("Distance" AS VARCHAR) AS racekey
  FROM raw_results)
"""
