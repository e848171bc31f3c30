"""Second time series on ``events``: the race operators with other column names.

entity = user_id, event = (event_type, day), measure = value in integer cents (exact fixed point:
sums are exact, so means do not depend on summation order); order = (ts, event, event_id).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.history import add_group_zscore, add_history
from ..sources.tables import table
from .catalog import register

_OUT = ["event_id", "user_id", "event_key", "value_z", "group_median_cents", "prior_count", "prior_avg_cents",
        "prior_std_cents", "prior_best_cents", "prior_avg_z", "recent_cents_roll3", "recent_z_roll3",
        "days_since_previous", "history_years"]

_SQL = """
WITH e AS (SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS value, event_type || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS event_key
           FROM events),
g AS (SELECT event_key, avg(value) AS m, stddev_samp(value) AS s, median(value) AS med FROM e GROUP BY event_key),
z AS (SELECT e.*, (value - g.m) / NULLIF(g.s, 0) AS value_z, g.med AS group_median_cents FROM e JOIN g USING (event_key))
SELECT event_id, user_id, event_key, value_z, group_median_cents,
  CAST(row_number() OVER w - 1 AS INTEGER) AS prior_count,
  avg(value) OVER wp AS prior_avg_cents, stddev_samp(value) OVER wp AS prior_std_cents,
  CAST(max(value) OVER wp AS DOUBLE) AS prior_best_cents, avg(value_z) OVER wp AS prior_avg_z,
  avg(value) OVER w3 AS recent_cents_roll3, avg(value_z) OVER w3 AS recent_z_roll3,
  CAST(date_diff('day', CAST(lag(ts) OVER w AS DATE), CAST(ts AS DATE)) AS DOUBLE) AS days_since_previous,
  date_diff('day', CAST(min(ts) OVER (PARTITION BY user_id) AS DATE), CAST(ts AS DATE)) / 365.25::DOUBLE AS history_years
FROM z
WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_key, event_id),
       wp AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_key, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       w3 AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_key, event_id
              ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""


@register("event_history", _SQL, doubles=("value_z", "group_median_cents", "prior_avg_cents", "prior_std_cents",
                                          "prior_best_cents", "prior_avg_z", "recent_cents_roll3", "recent_z_roll3",
                                          "days_since_previous", "history_years"))
def event_history(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("value"),
        F.concat(F.col("event_type"), F.lit("_"), F.to_date("ts").cast("string")).alias("event_key"))
    z = add_group_zscore(e, group="event_key", value="value", entity="user_id", median=True)
    h = add_history(z, entity="user_id", time="ts", event="event_key", tiebreak="event_id", speed="value",
                    z="speed_z_race")
    return h.select("event_id", "user_id", "event_key", F.col("speed_z_race").alias("value_z"),
                    F.col("race_median_speed").alias("group_median_cents"), F.col("prior_race_count").alias("prior_count"),
                    F.col("prior_avg_speed").alias("prior_avg_cents"), F.col("prior_std_speed").alias("prior_std_cents"),
                    F.col("prior_best_speed").cast("double").alias("prior_best_cents"), "prior_avg_z",
                    F.col("recent_speed_roll3").alias("recent_cents_roll3"), "recent_z_roll3",
                    F.col("days_since_last_race").alias("days_since_previous"),
                    F.col("runner_history_years").alias("history_years"))
