"""Data-profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import speed_kmh
from ..functions.text import match_key
from ..operators.ranking import group_quantiles


def with_derived(clean: DataFrame) -> DataFrame:
    """Speed, year and match key on cleaned results."""
    return (clean.withColumn("speed_kmh", speed_kmh("Distance", "temps_sec"))
                 .withColumn("year", F.year("Date"))
                 .withColumn("Nom_clean", match_key("Nom")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Occurrences per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def count_of_counts(df: DataFrame, col: str) -> DataFrame:
    """How many values occur 1, 2, 3 ... times."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n_results"))
              .groupBy("n_results").agg(F.count(F.lit(1)).alias("n_values")).orderBy("n_results"))


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, std, min, 25/50/75 % (exact, linear) and max per numeric column."""
    long_ = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(c).cast("double").alias("value")) for c in cols]))
                      .alias("kv")).select("kv.*")
    stats = long_.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = group_quantiles(long_, ["column_name"], "value", [0.25, 0.5, 0.75], "p")
    return stats.join(q, "column_name", "left")


def describe_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """A19 on text columns: non-null count, distinct count, most frequent value (ties: smallest) and its count."""
    long_ = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(c).cast("string").alias("value")) for c in cols]))
                      .alias("kv")).select("kv.*").where(F.col("value").isNotNull())
    per_value = long_.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").cast("long").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def distinct_per_group(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Rows and distinct values per group."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"),
                                 *[F.countDistinct(c).alias(f"distinct_{c.lower()}") for c in cols])


def active_entities(df: DataFrame, entity: str, measure: str, min_rows: int = 3) -> DataFrame:
    """J9 + A21: min / mean / max of a measure for entities with at least ``min_rows`` rows."""
    stats = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"), F.min(measure).alias("min_" + measure.lower()),
                                   F.avg(measure).alias("mean_" + measure.lower()),
                                   F.max(measure).alias("max_" + measure.lower()))
    return stats.where(F.col("n") >= min_rows)


def inconsistent_attribute(df: DataFrame, entity: str, attr: str, cols: list[str]) -> DataFrame:
    """Rows of entities seen with more than one distinct value of ``attr`` (HAVING + semi join)."""
    bad = df.groupBy(entity).agg(F.countDistinct(attr).alias("_k")).where(F.col("_k") > 1)
    return df.join(bad.select(entity), entity, "left_semi").select(entity, attr, *cols).orderBy(entity, *cols)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max, last bin closed on the right."""
    mn, mx = df.agg(F.min(col), F.max(col)).first()  # two scalars
    j = df.select(col, F.lit(mn).alias("_mn"), F.lit(mx).alias("_mx"))
    width = (F.col("_mx") - F.col("_mn")).cast("double")
    b = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col(col) - F.col("_mn")) * bins / width), F.lit(bins - 1)))
    h = j.withColumn("bin", b.cast("int")).groupBy("bin", "_mn", "_mx").agg(F.count(F.lit(1)).alias("count"))
    return h.select("bin", (F.col("_mn") + (F.col("_mx") - F.col("_mn")) * F.col("bin") / bins).alias("lower"),
                    (F.col("_mn") + (F.col("_mx") - F.col("_mn")) * (F.col("bin") + 1) / bins).alias("upper"),
                    "count")


def shape_profile(df: DataFrame) -> DataFrame:
    """Per column its type, non-null count and the row count (one pass)."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_nn{i}")
                                                        for i, c in enumerate(df.columns)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"_nn{i}").alias("non_null"), F.col("_rows").alias("rows"))
        for i, f in enumerate(df.schema.fields)])).alias("c")).select("c.*")


def membership_filters(df: DataFrame, col: str, keep: list[str], attr: str, not_value: str) -> DataFrame:
    """P10: ``col IN keep`` and ``attr != value`` with pandas semantics (null != value is true),
    plus the complement ``NOT IN`` that keeps nulls, counted per value."""
    inside = F.coalesce(F.col(col).isin(*keep), F.lit(False))
    differs = ~F.col(attr).eqNullSafe(F.lit(not_value))
    return df.groupBy(col).agg(
        F.count_if(inside & differs).alias("in_list_not_value"),
        F.count_if(~inside).alias("not_in_list"))



def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column in order, with their rank from 1 (null last)."""
    from ..operators.ranking import global_index
    ranked = global_index(df.select(col).distinct(), [F.col(col).asc_nulls_last()], "_i")
    return ranked.select((F.col("_i") + 1).alias("rank"), col)


def existence(df: DataFrame, **conditions) -> DataFrame:
    """One row with a flag per condition: does any row meet it? (one pass, no rows fetched)"""
    return df.agg(*[F.coalesce(F.max(F.coalesce(c, F.lit(False))), F.lit(False)).alias(k) for k, c in conditions.items()])


def first_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first n rows in an order (the listing that goes with shape, types and null counts)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


SKETCH_K = 12                            # 2^12 registers: a standard error of 1.04 / 64 = 1.6 percent
SKETCH_BOUND = 0.05                      # three standard errors, rounded up


def distinct_sketches(rows: DataFrame, by: str, value: str) -> DataFrame:
    """A16 / A20 as an option: a mergeable sketch of the distinct values per group, of fixed size whatever the rows."""
    return rows.groupBy(by).agg(F.hll_sketch_agg(value, F.lit(SKETCH_K)).alias("sketch"))


def estimated_distinct(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimates over any union of stored sketches, without their rows."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def sketched_distinct(sketches: DataFrame, rows: DataFrame, by: str, value: str) -> DataFrame:
    """Per group and over all (group NULL): the exact distinct count, and whether the sketches' estimate lies
    within ``SKETCH_BOUND`` of it."""
    none = F.lit(None).cast(rows.schema[by].dataType)
    exact = rows.groupBy(by).agg(F.countDistinct(value).alias("exact")).unionByName(rows.agg(F.countDistinct(value).alias("exact")).withColumn(by, none))
    found = estimated_distinct(sketches, by).unionByName(estimated_distinct(sketches).withColumn(by, none))
    both = exact.join(found.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by")))
    return both.select(by, "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), F.lit(SKETCH_BOUND) * F.col("exact"))).alias("within"))
