"""DuckDB twin of the model job: medians, scaling and the normal equations solved in SQL.

The OLS fit is the solution of the 15 x 15 normal equations over the training rows' standardised
features; a recursive query eliminates one column of the moment matrix per step. Predictions agree
with Spark's to rounding error, so the queries compare z at 5 and times at 2 decimals.
"""

from __future__ import annotations

from .model import FEATURE_COLUMNS
from .oracle import FEATURES_SQL

_N = len(FEATURE_COLUMNS)
_SIZE = _N + 1


def _each(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(c=c, i=i) for i, c in enumerate(FEATURE_COLUMNS, 1))


_MOMENTS = "[" + ", ".join(
    "[" + ", ".join(f"sum(z{i} * z{j})" for j in range(_SIZE)) + f", sum(z{i} * target_z)]" for i in range(_SIZE)) + "]"

MODEL_CTES = f"""
f AS ({FEATURES_SQL}),
s AS (SELECT *, CASE WHEN year = (SELECT max(year) FROM f) THEN 'test' WHEN year < (SELECT max(year) FROM f) THEN 'train' END AS split
      FROM f WHERE race_std_speed IS NOT NULL),
med AS (SELECT {_each("quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m{i}")} FROM s WHERE split = 'train'),
x AS (SELECT s.*, {_each("coalesce(CAST({c} AS DOUBLE), m{i}) AS x{i}")} FROM s, med WHERE split IS NOT NULL),
st AS (SELECT {_each("avg(x{i}) AS a{i}, stddev_pop(x{i}) AS d{i}")} FROM x WHERE split = 'train'),
zed AS (SELECT x.*, 1.0::DOUBLE AS z0, {_each("coalesce((x{i} - a{i}) / NULLIF(d{i}, 0), 0) AS z{i}")} FROM x, st),
mom AS (SELECT {_MOMENTS} AS m FROM zed WHERE split = 'train'),
gj(k, m) AS (
  SELECT 1, m FROM mom
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
                                ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END)
  FROM gj WHERE k <= {_SIZE}),
beta AS (SELECT list_transform(m, lambda r: r[{_SIZE + 1}]) AS b FROM gj WHERE k = {_SIZE + 1}),
_p0 AS (SELECT zed.*, b[1] + {_each("b[{i} + 1] * z{i}", " + ")} AS predicted_z FROM zed, beta),
_p1 AS (SELECT *, CASE WHEN race_mean_speed + predicted_z * race_std_speed < 1 THEN 1.0::DOUBLE
                       ELSE race_mean_speed + predicted_z * race_std_speed END AS predicted_speed_kmh FROM _p0),
pred AS (SELECT source_result_id, runner_id, race_id, target_z, actual_time_sec AS target_time_sec, predicted_z,
                100.0::DOUBLE + 10.0::DOUBLE * predicted_z AS predicted_performance_index, predicted_speed_kmh,
                distance / NULLIF(predicted_speed_kmh, 0) * 3600.0::DOUBLE AS predicted_time_sec,
                abs(actual_time_sec - distance / NULLIF(predicted_speed_kmh, 0) * 3600.0::DOUBLE) AS abs_error_time_sec, split
         FROM _p1)"""

COEFFICIENTS = " UNION ALL ".join(f"SELECT '{c}' AS feature, b[{i} + 1] AS coefficient FROM beta" for i, c in enumerate(FEATURE_COLUMNS, 1))


def model_sql(body: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([MODEL_CTES.strip(), *[c.strip() for c in ctes]]) + "\n" + body


# one what-if probe's prediction from its own features
PROBE_Z = "b[1] + " + _each("b[{i} + 1] * coalesce((coalesce(CAST(q.{c} AS DOUBLE), m{i}) - a{i}) / NULLIF(d{i}, 0), 0)", " + ")
