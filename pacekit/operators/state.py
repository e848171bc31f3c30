"""Stored, mergeable history state: one row of moments and a tail per entity.

The history features (W5-W11) of a row depend on its entity's earlier rows only through their number, the
count, mean, M2 and maximum of each measure, the first date and the last three rows. That is kept per
entity, so that new results are scored against the state instead of against the whole history, and the
state is then extended by them. States merge in any grouping, in the order of time, with the parallel
variance formula.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe
from .prefix import _last, _moments_merge, add_history_split

MEASURES = {"s": "speed_kmh", "z": "speed_z_race"}


def history_state(rows: DataFrame, entity: str = "runner_id", time: str = "date", event: str = "race_id", tiebreak: str = "result_id",
                  speed: str = "speed_kmh", z: str = "speed_z_race") -> DataFrame:
    """The state that ``rows`` leave: ``entity, rows, first_date, tail`` and ``n, m, q, x`` of both measures.

    Plain aggregations with map-side combine; of a hot entity's rows each task ships three (Spark limits the
    ranked rows before the shuffle).
    """
    aggregates = [F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_date")]
    for tag, c in (("s", speed), ("z", z)):
        n = F.count(c)
        aggregates += [n.alias(f"n{tag}"), F.coalesce(F.avg(c), F.lit(0.0)).alias(f"m{tag}"),
                       F.coalesce(F.var_pop(c) * n, F.lit(0.0)).alias(f"q{tag}"), F.max(c).alias(f"x{tag}")]
    latest = Window.partitionBy(entity).orderBy(F.col(time).desc_nulls_first(), F.desc(event), F.desc(tiebreak))
    last3 = rows.select(entity, F.col(speed).cast("double").alias("v"), F.col(z).cast("double").alias("z"), F.col(time).alias("d"),
                        F.row_number().over(latest).alias("_k")).where(F.col("_k") <= 3)
    tails = last3.groupBy(entity).agg(F.transform(F.sort_array(F.collect_list(F.struct(-F.col("_k"), "v", "z", "d"))),
                                                  lambda r: F.struct(r["v"].alias("v"), r["z"].alias("z"), r["d"].alias("d"))).alias("tail"))
    return join_null_safe(rows.groupBy(entity).agg(*aggregates), tails, [entity])


def merge_states(before: DataFrame, after: DataFrame, entity: str = "runner_id") -> DataFrame:
    """The state of earlier rows extended by that of later ones; entities of either side are kept."""
    a, b = before.alias("a"), after.alias("b")
    j = a.join(b, F.col(f"a.{entity}").eqNullSafe(F.col(f"b.{entity}")), "full_outer")
    def of(side: str, c: str):
        return F.col(f"{side}.{c}")
    def count(side: str, c: str):
        return F.coalesce(of(side, c), F.lit(0).cast("long"))
    empty = F.slice(F.coalesce(of("a", "tail"), of("b", "tail")), 1, 0)
    out = [F.coalesce(of("a", entity), of("b", entity)).alias(entity), (count("a", "rows") + count("b", "rows")).alias("rows"),
           F.least(of("a", "first_date"), of("b", "first_date")).alias("first_date"),
           _last(F.concat(F.coalesce(of("a", "tail"), empty), F.coalesce(of("b", "tail"), empty)), 3).alias("tail")]
    for tag in MEASURES:
        n, mean, m2 = _moments_merge(*[F.coalesce(of(s, f"{p}{tag}"), F.lit(0).cast("long") if p == "n" else F.lit(0.0)) for s in "ab" for p in "nmq"])
        out += [n.alias(f"n{tag}"), mean.alias(f"m{tag}"), m2.alias(f"q{tag}"), F.greatest(of("a", f"x{tag}"), of("b", f"x{tag}")).alias(f"x{tag}")]
    return j.select(*out).select(entity, "rows", "first_date", *[f"{p}{t}" for t in MEASURES for p in "nmqx"], "tail")


def extend_history(rows: DataFrame, state: DataFrame | None, entity: str = "runner_id") -> tuple[DataFrame, DataFrame]:
    """History features of new rows, all later than the stored ones, and the state after them."""
    features = add_history_split(rows, entity, state=state)
    own = history_state(rows, entity)
    return features, own if state is None else merge_states(state, own, entity)
