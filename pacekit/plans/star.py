"""Reports on the stored star schema: the fact table's layout does the work.

Facts lie in a partition per year and in buckets by runner (:mod:`..sources.warehouse`). A report that
selects races through the dimension reads only the years that the selection leaves (dynamic partition
pruning: the join is on the race and its year); one that works by runner takes the buckets as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_div
from ..sources import warehouse as WH


def facts(spark: SparkSession, root: str, races: DataFrame | None = None) -> DataFrame:
    """Facts joined with (a selection of) the races on race and year."""
    f = spark.table(f"{root}.{WH.FACT}")
    if races is None:
        return f
    key = races.withColumn("load_year", F.coalesce("year", F.lit(0)))
    return f.join(key, ["race_id", "load_year"])


def dim_race(spark: SparkSession, root: str) -> DataFrame:
    return spark.table(f"{root}.{WH.DIM_RACE}")


def overview(spark: SparkSession, root: str) -> DataFrame:
    """A1: the key figures."""
    races = dim_race(spark, root).select("race_id", "year", "distance")
    return facts(spark, root, races).agg(
        F.countDistinct("runner_id").alias("runners"), F.countDistinct("race_id").alias("races"), F.count(F.lit(1)).alias("results"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.sum("distance").alias("total_distance"))


def races_of_year(spark: SparkSession, root: str, year: int | None = None) -> DataFrame:
    """A4: the races of a year (the latest one by default) with their crowd, mean speed and pace."""
    races = dim_race(spark, root)
    year = races.agg(F.max("year")).first()[0] if year is None else year
    chosen = races.where(F.col("year") == year).select("race_id", "year", "name", "date", "distance")
    crowd = facts(spark, root, chosen).groupBy("race_id", "name", "date", "distance").agg(
        F.count(F.lit(1)).alias("participants"), F.avg("speed_kmh").alias("avg_speed"), F.avg("time_sec").alias("_time"))
    return crowd.withColumn("avg_pace_sec_km", safe_div("_time", "distance")).drop("_time")


def runner_history(spark: SparkSession, root: str) -> DataFrame:
    """Of every result: how many the runner had before, the speed of the last one and the best.

    One window per runner, in the order results were loaded; the buckets of the fact table are its
    partitions. A runner holding a large share of all results is one task here: for that case the history
    features use the segmented scan (``operators.prefix``).
    """
    w = Window.partitionBy("runner_id").orderBy("result_id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return facts(spark, root).select(
        "result_id", "runner_id", "race_id", (F.row_number().over(w) - 1).cast("long").alias("prior_races"),
        F.lag("speed_kmh").over(w).alias("previous_speed"), F.max("speed_kmh").over(before).alias("prior_best_speed"))
