"""Skew-safe leakage-free history (W5-W11) as a segmented prefix scan.

``history.add_history`` uses one window per entity: correct, but an entity
holding a third of all rows is one task.  Here the rows are range-partitioned
on (entity, order) -- Spark cuts a hot entity across many partitions -- and
the order is fixed once with a cut to files.  Each (partition, entity)
*segment* computes its local prefix aggregates with ordinary windows; the
state carried in from the entity's earlier segments (count, mean, M2 and max
per measure, earliest date, last three rows) comes from a small table with one
row per segment.  Moments are merged with the parallel-variance formula
(Chan et al.), the same merge Spark uses for partial aggregates, so the result
equals the window version to floating-point rounding.

Only entities of more than ``HOT_ROWS`` rows need that; their number is that of
the rows over ``HOT_ROWS`` at most, and :func:`hot_entities` finds them by a count. All others
take plain windows after one exchange by entity (:func:`add_history_split`), nothing written in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_to_files
from .joins import join_null_safe

_POS_BITS = 33
HOT_ROWS = 100_000          # rows of an entity that one task sorts without strain


def _last(arr: Column, k: int) -> Column:
    """Last k elements (all when shorter); ``slice(arr, -k, k)`` returns [] for short arrays."""
    return F.slice(arr, F.greatest(F.size(arr) - (k - 1), F.lit(1)), k)


def _moments_merge(a_n, a_mean, a_m2, b_n, b_mean, b_m2):
    """Chan et al. merge of (n, mean, M2) pairs; handles empty sides."""
    n = a_n + b_n
    delta = b_mean - a_mean
    mean = F.when(a_n == 0, b_mean).when(b_n == 0, a_mean).otherwise(a_mean + delta * b_n / n)
    m2 = (F.when(a_n == 0, b_m2).when(b_n == 0, a_m2)
           .otherwise(a_m2 + b_m2 + delta * delta * a_n * b_n / n))
    return n, mean, m2


def _running_moments(tag: str, before) -> Column:
    """struct(n, mean, m2) of all earlier segments, from running sums around a shift ``k`` of the
    entity (its first mean, so that the squares stay small): linear in the segments."""
    k, n = F.col(f"k{tag}"), F.coalesce(F.col(f"n{tag}"), F.lit(0))
    d = F.when(n > 0, F.col(f"m{tag}") - k).otherwise(0.0)
    s0 = F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long")
    s1 = F.coalesce(F.sum(n * d).over(before), F.lit(0.0))
    s2 = F.coalesce(F.sum(F.coalesce(F.col(f"q{tag}"), F.lit(0.0)) + n * d * d).over(before), F.lit(0.0))
    some = s0 > 0
    return F.struct(s0.alias("n"), F.when(some, k + s1 / s0).otherwise(0.0).alias("mean"),
                    F.when(some, F.greatest(s2 - s1 * s1 / s0, F.lit(0.0))).otherwise(0.0).alias("m2"))


def _sorted_segments(df: DataFrame, keys: list, n: int) -> DataFrame:
    """Range-partition + sort on ``keys``; ``_pid`` / ``_lpos`` fixed by a cut."""
    s = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_lpos", F.monotonically_increasing_id()
                       - F.shiftleft(F.spark_partition_id().cast("long"), _POS_BITS)))
    return cut_to_files(s)


def hot_entities(df: DataFrame, entity: str, hot_rows: int | None = None) -> list:
    """The entities (null may be one) of more than ``hot_rows`` rows."""
    counted = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > (HOT_ROWS if hot_rows is None else hot_rows))
    return [r[0] for r in counted.select(entity).collect()]


def split_hot(df: DataFrame, entity: str, hot: list) -> tuple[DataFrame, DataFrame]:
    """``(ordinary, hot)`` rows."""
    some = [x for x in hot if x is not None]
    is_hot = F.coalesce(F.col(entity).isin(some), F.lit(False)) | F.lit(None in hot) & F.col(entity).isNull()
    return df.where(~is_hot), df.where(is_hot)


def fill_last_segmented(df: DataFrame, entity: str, order: list, value: str, out: str,
                        n_parts: int | None = None) -> DataFrame:
    """``last(value, ignorenulls) over (partition by entity order by order rows unbounded..current)``
    without confining an entity to one task: local fill per (partition, entity) segment, plus the
    last non-null value of the entity's earlier segments (one row per segment)."""
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = _sorted_segments(df, [F.col(entity)] + order, n)
    seg = Window.partitionBy("_pid", entity).orderBy("_lpos")
    w = s.withColumn("_loc", F.last(value, ignorenulls=True).over(seg.rowsBetween(Window.unboundedPreceding, 0)))
    segs = w.groupBy("_pid", entity).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_lpos"))).alias("_seglast"))
    before = Window.partitionBy(entity).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = segs.select("_pid", entity, F.last("_seglast", ignorenulls=True).over(before).alias("_carry"))
    j = join_null_safe(w, carry, ["_pid", entity])
    return j.withColumn(out, F.coalesce(F.col("_loc"), F.col("_carry"))).drop("_pid", "_lpos", "_loc", "_carry")


def _with_state(carry: DataFrame, state: DataFrame, entity: str) -> DataFrame:
    """The segments' carry after what an entity's stored state holds."""
    j = join_null_safe(carry, state.select(entity, F.struct(*[c for c in state.columns if c != entity]).alias("_st")), [entity], "left")
    st, zero = F.col("_st"), F.lit(0).cast("long")
    out = {"c_rows": F.col("c_rows") + F.coalesce(st["rows"], zero), "c_dmin": F.least(F.col("c_dmin"), st["first_date"]),
           "c_tail": _last(F.concat(F.coalesce(st["tail"], F.slice(F.col("c_tail"), 1, 0)), F.col("c_tail")), 3)}
    for tag in ("s", "z"):
        c = F.col(f"c_mom{tag}")
        n, mean, m2 = _moments_merge(F.coalesce(st[f"n{tag}"], zero), F.coalesce(st[f"m{tag}"], F.lit(0.0)), F.coalesce(st[f"q{tag}"], F.lit(0.0)),
                                     c["n"], c["mean"], c["m2"])
        out[f"c_mom{tag}"] = F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))
        out[f"c_x{tag}"] = F.greatest(F.col(f"c_x{tag}"), st[f"x{tag}"])
    return j.select("_pid", entity, *[v.alias(k) for k, v in out.items()])


def add_history_segmented(df: DataFrame, entity: str = "runner_id", time: str = "date", event: str = "race_id",
                          tiebreak: str = "result_id", speed: str = "speed_kmh", z: str = "speed_z_race",
                          n_parts: int | None = None, inclusive: bool = False, state: DataFrame | None = None) -> DataFrame:
    """Same columns and values as ``history.add_history``; no entity is confined to one task.

    ``inclusive=True`` gives the state *after* each row (its own row included): what a later
    as-of lookup needs. ``state`` (:func:`.state.history_state`: a row per entity) is what all earlier rows,
    which ``df`` does not hold, have left; it is merged into what each segment carries in.
    """
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(entity), F.col(time).asc_nulls_last(), F.col(event), F.col(tiebreak)]
    s = _sorted_segments(df, keys, n)

    seg = Window.partitionBy("_pid", entity).orderBy("_lpos")
    hi = 0 if inclusive else -1
    prev = seg.rowsBetween(Window.unboundedPreceding, hi)
    upto = seg.rowsBetween(Window.unboundedPreceding, 0)
    row = F.struct(F.col(speed).cast("double").alias("v"), F.col(z).cast("double").alias("z"),
                   F.col(time).alias("d"))
    meas = {"s": speed, "z": z}
    cols = [(F.row_number().over(seg) + hi).alias("_k"),
            F.collect_list(row).over(seg.rowsBetween(hi - 2, hi)).alias("_prev3"),
            F.collect_list(row).over(seg.rowsBetween(-2, 0)).alias("_tail3"),
            F.min(time).over(upto).alias("_dmin")]
    for tag, c in meas.items():
        cols += [F.count(c).over(prev).alias(f"_n{tag}"), F.avg(c).over(prev).alias(f"_m{tag}"),
                 (F.var_samp(c).over(prev) * (F.count(c).over(prev) - 1)).alias(f"_q{tag}"),
                 F.max(c).over(prev).alias(f"_x{tag}"),
                 # segment totals (whole segment), for the carry table
                 F.count(c).over(seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"_Tn{tag}"),
                 F.avg(c).over(seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"_Tm{tag}"),
                 (F.var_samp(c).over(seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                  * (F.count(c).over(seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - 1))
                 .alias(f"_Tq{tag}"),
                 F.max(c).over(seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"_Tx{tag}")]
    w = s.select("*", *cols)

    # one row per segment: totals and its last three rows
    agg = [F.count(F.lit(1)).alias("rows"), F.min("_dmin").alias("dmin"),
           F.max_by("_tail3", "_lpos").alias("tail")]
    for tag in meas:
        agg += [F.first(f"_Tn{tag}").alias(f"n{tag}"), F.first(f"_Tm{tag}").alias(f"m{tag}"),
                F.first(f"_Tq{tag}").alias(f"q{tag}"), F.first(f"_Tx{tag}").alias(f"x{tag}")]
    segs = w.groupBy("_pid", entity).agg(*agg)
    by_entity = Window.partitionBy(entity).orderBy("_pid")
    before = by_entity.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_entity.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry_cols = [F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("c_rows"),
                  F.min("dmin").over(before).alias("c_dmin"),
                  # every segment has a row at least: the last three rows lie in the last three segments
                  _last(F.flatten(F.collect_list("tail").over(by_entity.rowsBetween(-3, -1))), 3).alias("c_tail")]
    for tag in meas:
        segs = segs.withColumn(f"k{tag}", F.coalesce(F.first(f"m{tag}", ignorenulls=True).over(whole), F.lit(0.0)))
        carry_cols += [_running_moments(tag, before).alias(f"c_mom{tag}"),
                       F.max(f"x{tag}").over(before).alias(f"c_x{tag}")]
    carry = segs.select("_pid", entity, *carry_cols)   # one row per segment
    if state is not None:
        carry = _with_state(carry, state, entity)
    j = join_null_safe(w, carry, ["_pid", entity])

    out = j.withColumn("prior_race_count", (F.col("c_rows") + F.col("_k")).cast("int"))
    names = {"s": ("prior_avg_speed", "prior_std_speed", "prior_best_speed"),
             "z": ("prior_avg_z", "prior_std_z", "prior_best_z")}
    for tag, (avg_name, std_name, max_name) in names.items():
        a = F.col(f"c_mom{tag}")
        bn = F.col(f"_n{tag}").cast("long")
        tn, tmean, tm2 = _moments_merge(a["n"], a["mean"], a["m2"], bn, F.coalesce(F.col(f"_m{tag}"), F.lit(0.0)),
                                        F.coalesce(F.col(f"_q{tag}"), F.lit(0.0)))
        out = (out.withColumn(avg_name, F.when(tn > 0, tmean))
                  .withColumn(std_name, F.when(tn > 1, F.sqrt(F.greatest(tm2, F.lit(0.0)) / (tn - 1))))
                  .withColumn(max_name, F.greatest(F.col(f"c_x{tag}"), F.col(f"_x{tag}"))))
    empty = F.slice(F.col("_prev3"), 1, 0)   # typed empty array
    prev3 = _last(F.concat(F.coalesce(F.col("c_tail"), empty), F.col("_prev3")), 3)
    out = out.withColumn("_p3", prev3)
    def mean_of(field):
        vals = F.filter(F.transform("_p3", lambda r: r[field]), lambda x: x.isNotNull())
        return F.when(F.size(vals) > 0, F.aggregate(vals, F.lit(0.0), lambda a, x: a + x) / F.size(vals))
    last_date = F.try_element_at(F.col("_p3"), F.lit(-1))["d"]
    out = (out.withColumn("recent_speed_roll3", mean_of("v"))
              .withColumn("recent_z_roll3", mean_of("z"))
              .withColumn("last_date", last_date)
              .withColumn("first_date", F.least(F.col("c_dmin"), F.col("_dmin")))
              .withColumn("days_since_last_race", F.datediff(F.col(time), last_date).cast("double"))
              .withColumn("runner_history_years",
                          F.datediff(F.col(time), F.least(F.col("c_dmin"), F.col("_dmin"))) / F.lit(365.25)))
    drop = [c for c in out.columns if c.startswith("_") or c.startswith("c_")]
    if not inclusive:
        drop += ["last_date", "first_date"]
    return out.drop(*drop)


def add_history_split(df: DataFrame, entity: str = "runner_id", time: str = "date", event: str = "race_id", tiebreak: str = "result_id",
                      speed: str = "speed_kmh", z: str = "speed_z_race", state: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """:func:`add_history_segmented` for the entities of more than ``hot_rows`` rows, windows by entity for all others."""
    args = (entity, time, event, tiebreak, speed, z)
    hot = hot_entities(df, entity, hot_rows)
    ordinary, many = split_hot(df, entity, hot) if hot else (df, None)
    out = _history_by_entity(ordinary, *args, state=state)
    return out if many is None else out.unionByName(add_history_segmented(many, *args, state=state))


def _history_by_entity(df: DataFrame, entity: str, time: str, event: str, tiebreak: str, speed: str, z: str, state: DataFrame | None) -> DataFrame:
    """The features by windows over an entity's rows, after one exchange; a stored state is one more row, before all others."""
    from .history import add_history_windows
    if state is None:
        return add_history_windows(df, entity, time, event, tiebreak, speed, z)
    held = F.struct(*[c for c in state.columns if c != entity])
    stored = state.select(F.col(entity), held.alias("_state"))
    kind = stored.schema["_state"].dataType
    stream = df.withColumn("_state", F.lit(None).cast(kind)).unionByName(stored, allowMissingColumns=True)
    w = Window.partitionBy(entity).orderBy(F.col("_state").isNull(), F.col(time).asc_nulls_last(), F.col(event), F.col(tiebreak))
    past, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    is_row = F.col("_state").isNull()
    row = F.when(is_row, F.struct(F.col(speed).cast("double").alias("v"), F.col(z).cast("double").alias("z"), F.col(time).alias("d")))
    cols = [F.first("_state").over(upto).alias("_st"), F.coalesce(F.sum(is_row.cast("long")).over(past), F.lit(0).cast("long")).alias("_k"),
            F.collect_list(row).over(w.rowsBetween(-3, -1)).alias("_prev3"), F.min(time).over(upto).alias("_dmin")]
    for tag, c in (("s", speed), ("z", z)):
        n = F.count(c).over(past)
        cols += [n.alias(f"_n{tag}"), F.coalesce(F.avg(c).over(past), F.lit(0.0)).alias(f"_m{tag}"),
                 F.coalesce(F.var_pop(c).over(past) * n, F.lit(0.0)).alias(f"_q{tag}"), F.max(c).over(past).alias(f"_x{tag}")]
    s = stream.select("*", *cols).where(is_row)
    st, zero = F.col("_st"), F.lit(0).cast("long")
    tail = _last(F.concat(F.coalesce(st["tail"], F.slice(F.col("_prev3"), 1, 0)), F.col("_prev3")), 3)
    s = s.withColumn("_p3", tail)

    def mean_of(field):
        vals = F.filter(F.transform("_p3", lambda r: r[field]), lambda x: x.isNotNull())
        return F.when(F.size(vals) > 0, F.aggregate(vals, F.lit(0.0), lambda a, x: a + x) / F.size(vals))
    feats = [(F.coalesce(st["rows"], zero) + F.col("_k")).cast("int").alias("prior_race_count")]
    for tag, name in (("s", "speed"), ("z", "z")):
        n, mean, m2 = _moments_merge(F.coalesce(st[f"n{tag}"], zero), F.coalesce(st[f"m{tag}"], F.lit(0.0)), F.coalesce(st[f"q{tag}"], F.lit(0.0)),
                                     F.col(f"_n{tag}"), F.col(f"_m{tag}"), F.col(f"_q{tag}"))
        feats += [F.when(n > 0, mean).alias(f"prior_avg_{name}"), F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1))).alias(f"prior_std_{name}"),
                  F.greatest(st[f"x{tag}"], F.col(f"_x{tag}")).alias(f"prior_best_{name}")]
    feats += [mean_of("v").alias("recent_speed_roll3"), mean_of("z").alias("recent_z_roll3"),
              F.datediff(F.col(time), F.try_element_at(F.col("_p3"), F.lit(-1))["d"]).cast("double").alias("days_since_last_race"),
              (F.datediff(F.col(time), F.least(st["first_date"], F.col("_dmin"))) / F.lit(365.25)).alias("runner_history_years")]
    return s.select(*df.columns, *feats)
