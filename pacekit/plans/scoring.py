"""Batch "what if" scoring of (runner, race) pairs.

For every probe pair the runner's history is summarised *as of* the race date
(strictly earlier results with a defined z).  Instead of joining every probe
with every earlier result, running aggregates are computed on the result rows
in one window pass, packed into a struct, and each probe picks the latest
state with ``last(state, ignorenulls)`` -- probes sort before same-day results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip_lower, safe_div
from ..plans.reports import race_stats
from ..operators.joins import join_checked
from ..operators.prefix import add_history_segmented, fill_last_segmented, hot_entities, split_hot
from ..session import cut_to_files

MIN_HISTORY = 3


def history_state(results: DataFrame) -> DataFrame:
    """Running state after each valid result (z defined), ordered by (date, race_id, result_id)."""
    return running_state(_valid_results(results))


def running_state(valid: DataFrame) -> DataFrame:
    """The same of valid results."""
    w = Window.partitionBy("runner_id").orderBy("date", "race_id", "result_id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    tail3 = w.rowsBetween(-2, 0)
    state = F.struct(
        F.count(F.lit(1)).over(run).cast("int").alias("prior_race_count"),
        F.avg("speed_kmh").over(run).alias("prior_avg_speed"),
        F.stddev_samp("speed_kmh").over(run).alias("prior_std_speed"),
        F.max("speed_kmh").over(run).alias("prior_best_speed"),
        F.avg("speed_z_race").over(run).alias("prior_avg_z"),
        F.stddev_samp("speed_z_race").over(run).alias("prior_std_z"),
        F.max("speed_z_race").over(run).alias("prior_best_z"),
        F.avg("speed_kmh").over(tail3).alias("recent_speed_roll3"),
        F.avg("speed_z_race").over(tail3).alias("recent_z_roll3"),
        F.col("date").alias("last_date"),
        F.min("date").over(run).alias("first_date"))
    return valid.select("runner_id", "date", "race_id", "result_id", state.alias("state"))


def asof_features(results: DataFrame, races: DataFrame, probes: DataFrame, segmented: bool = True) -> DataFrame:
    """J8 + W16: serving features for probe pairs (runner_id, race_id) as of the race date.

    ``segmented=True`` (default): results and probes of a runner take one exchange and one sort; runners of many
    rows the segmented prefix scan and the segmented last-value fill, so that none of them is confined to one task.
    """
    if segmented:
        p = join_checked(probes.select("runner_id", "race_id").distinct(), races.select("race_id", "date", "distance"), "race_id")
        return _asof(results, cut_to_files(p.where(F.col("runner_id").isNotNull())))
    p = join_checked(probes.select("runner_id", "race_id").distinct(), races.select("race_id", "date", "distance"), "race_id")
    hist = history_state(results)
    cols = ["runner_id", "date", "race_id", "result_id"]
    stream = (hist.select(*cols, F.lit(1).alias("_is_result"), "state")
                  .unionByName(p.select("runner_id", "date", "race_id", F.lit(None).cast("long").alias("result_id"),
                                        F.lit(0).alias("_is_result"),
                                        F.lit(None).cast(hist.schema["state"].dataType).alias("state"))))
    got = _filled(stream).where(F.col("_is_result") == 0).select("runner_id", "race_id", "date", "_st")
    out = got.join(p.select("runner_id", "race_id", "distance"), ["runner_id", "race_id"])
    return out.select(
        "runner_id", "race_id", "distance", F.month("date").alias("race_month"),
        F.dayofyear("date").alias("race_dayofyear"),
        F.coalesce(F.col("_st.prior_race_count"), F.lit(0)).cast("int").alias("prior_race_count"),
        *[F.col(f"_st.{c}").alias(c) for c in ["prior_avg_speed", "prior_std_speed", "prior_best_speed",
                                                "prior_avg_z", "prior_std_z", "prior_best_z",
                                                "recent_speed_roll3", "recent_z_roll3"]],
        F.datediff("date", F.col("_st.last_date")).cast("double").alias("days_since_last_race"),
        (F.datediff("date", F.col("_st.first_date")) / F.lit(365.25)).alias("runner_history_years"))


def whatif(results: DataFrame, races: DataFrame, probes: DataFrame, model=None,
           min_history: int = MIN_HISTORY) -> DataFrame:
    """M9: one row per probe with status / reason instead of an early return; predictions when a
    model is given and the status is 'ok'."""
    rs = results.groupBy("race_id").agg(F.count(F.lit(1)).alias("race_participants"),
                                        F.avg("speed_kmh").alias("race_mean_speed"),
                                        F.stddev_samp("speed_kmh").alias("race_std_speed"))
    ran = results.select("runner_id", "race_id").distinct().withColumn("_ran", F.lit(True))
    # one row per pair asked for, with how often it was: it carries what the status needs through the as-of pass
    asked = (probes.groupBy("runner_id", "race_id").agg(F.count(F.lit(1)).alias("_times")).join(ran, ["runner_id", "race_id"], "left")
             .join(races.select("race_id", "date", "distance").withColumn("_known", F.lit(True)), "race_id", "left"))
    asked = cut_to_files(asked.withColumn("_known", F.when(F.col("runner_id").isNotNull(), F.col("_known"))))
    feats = _asof(results, asked.where(F.col("_known")), ("_times", "_ran", "_known"))
    unknown = asked.where(F.col("_known").isNull())
    feats = feats.unionByName(unknown.select(*[F.col(c) if c in ("runner_id", "race_id", "_times", "_ran", "_known")
                                               else F.lit(None).cast(feats.schema[c].dataType).alias(c) for c in feats.columns]))
    again = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    feats = feats.withColumn("_i", again).drop("_i", "_times")
    base = feats.join(rs, "race_id", "left")
    shown = [c for c in feats.columns if c not in ("runner_id", "race_id", "_ran", "_known")]
    base = base.select("runner_id", "race_id", "_known", "_ran", *[c for c in rs.columns if c != "race_id"], *shown)
    status = (F.when(F.col("_known").isNull(), "race_not_found")
               .when(F.col("_ran").isNotNull(), "already_run")
               .when(F.col("race_std_speed").isNull() | (F.col("race_std_speed") <= 0), "race_baseline_unreliable")
               .when(F.coalesce(F.col("prior_race_count"), F.lit(0)) < min_history, "not_enough_history")
               .otherwise("ok"))
    out = base.withColumn("status", status).drop("_known", "_ran")
    if model is None:
        return out
    # one pass: the model sees every row, only those whose status is 'ok' keep what it says
    scored = model.transform(out).select(*out.columns, F.when(F.col("status") == "ok", F.col("predicted_z")).alias("predicted_z"))
    speed = clip_lower(F.col("race_mean_speed") + F.col("predicted_z") * F.col("race_std_speed"), 1.0)
    return (scored.withColumn("predicted_performance_index", F.lit(100.0) + 10.0 * F.col("predicted_z"))
                  .withColumn("predicted_speed_kmh", F.when(F.col("status") == "ok", speed))
                  .withColumn("predicted_time_sec", safe_div("distance", "predicted_speed_kmh") * 3600.0)
                  .withColumn("predicted_pace_sec_km", safe_div("predicted_time_sec", "distance")))


_STATE_FIELDS = ["prior_race_count", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z",
                 "prior_std_z", "prior_best_z", "recent_speed_roll3", "recent_z_roll3", "last_date", "first_date"]


def _valid_results(results: DataFrame) -> DataFrame:
    """The results that count as history: a date and a defined z."""
    r = join_checked(results, race_stats(results), "race_id")
    r = r.withColumn("speed_z_race", safe_div(F.col("speed_kmh") - F.col("race_mean_speed"), "race_std_speed"))
    return r.where(F.col("speed_z_race").isNotNull() & F.col("date").isNotNull()).select(
        "runner_id", "date", "race_id", "result_id", "speed_kmh", "speed_z_race")


def _asof(results: DataFrame, probes: DataFrame, kept: tuple[str, ...] = (), hot_rows: int | None = None) -> DataFrame:
    """As-of features of the distinct ``probes`` (runner_id, race_id, date, distance), with their ``kept`` columns."""
    valid = _valid_results(results)
    hot = hot_entities(valid.select("runner_id").unionAll(probes.select("runner_id")), "runner_id", hot_rows)
    many = None
    if hot:
        (valid, many), (probes, many_probes) = split_hot(valid, "runner_id", hot), split_hot(probes, "runner_id", hot)
    got = _state_by_runner(valid, probes, kept)
    got = got if many is None else got.unionByName(_state_segmented(many, many_probes, kept))
    return got.select(
        "runner_id", "race_id", "distance", F.month("date").alias("race_month"),
        F.dayofyear("date").alias("race_dayofyear"),
        F.coalesce(F.col("_st.prior_race_count"), F.lit(0)).cast("int").alias("prior_race_count"),
        *[F.col(f"_st.{c}").alias(c) for c in _STATE_FIELDS[1:9]],
        F.datediff("date", F.col("_st.last_date")).cast("double").alias("days_since_last_race"),
        (F.datediff("date", F.col("_st.first_date")) / F.lit(365.25)).alias("runner_history_years"), *kept)


def _stream(valid: DataFrame, probes: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    """Results and probes as rows of one kind; probes (``_is_result`` 0) come before the results of their day."""
    of = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    own = [c for c in valid.columns if c not in ("runner_id", "date", "race_id")]
    return (valid.select("*", F.lit(1).alias("_is_result"), *[of(probes, c) for c in ("distance", *kept)])
                 .unionByName(probes.select("runner_id", "date", "race_id", *[of(valid, c) for c in own],
                                            F.lit(0).alias("_is_result"), "distance", *kept)))


def _filled(stream: DataFrame) -> DataFrame:
    """``_st``: the last state up to a row of its runner."""
    w = (Window.partitionBy("runner_id").orderBy("date", "_is_result", "race_id", "result_id")
               .rowsBetween(Window.unboundedPreceding, 0))
    return stream.withColumn("_st", F.last("state", ignorenulls=True).over(w))


def _state_by_runner(valid: DataFrame, probes: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    """``_st`` of each probe: the state after its runner's last result before it, by windows over the runner's rows."""
    return _filled(_stream(running_state(valid), probes, kept)).where(F.col("_is_result") == 0).select(
        "runner_id", "race_id", "date", "distance", *kept, "_st")


def _state_segmented(valid: DataFrame, probes: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    """The same for runners of many rows: state after each valid result by the segmented scan, filled in for the probes."""
    st = add_history_segmented(valid, inclusive=True)
    st = st.select("runner_id", "date", "race_id", "result_id", F.struct(*_STATE_FIELDS).alias("state"))
    order = [F.col("date"), F.col("_is_result"), F.col("race_id"), F.col("result_id")]
    return fill_last_segmented(_stream(st, probes, kept), "runner_id", order, "state", "_st").where(F.col("_is_result") == 0).select(
        "runner_id", "race_id", "date", "distance", *kept, "_st")
