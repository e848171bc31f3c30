"""Deterministic adapters: driver tables -> the race-result data model.

The driver's tables are not race results; these functions derive a results
fact, a runner and a race dimension, a names table and extracted table cells
from them with plain column expressions, so every job in the package runs on
data whose size grows with the driver's scale factor.

Results adapter (from ``orders``)::

    result_id = o_orderkey, runner_id = o_custkey
    race_id   = (year(o_orderdate) - 1995) * 12 + month(o_orderdate)
    date      = first day of the order month, year = year(date)
    keep the smallest result_id per (runner_id, race_id)
    distance  = 5.0 + race_id % 16
    time_sec  = floor(distance / (6.0 + o_totalprice / 50000.0) * 3600.0)
    speed_kmh = distance / (time_sec / 3600.0)
    category  = o_orderpriority
    position  = rank in the race by (time_sec, result_id)
    position_category = rank in (race, category) by (time_sec, result_id)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_first
from ..operators.ranking import group_row_number
from ..session import stage_table
from .tables import table


def base_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results before ranking: one row per (runner, race), first order wins."""
    return stage_table(spark, f"base_results:{sf_dir}", lambda: _base_results(spark, sf_dir))


def _base_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    raw = o.select(
        F.col("o_orderkey").alias("result_id"),
        F.col("o_custkey").alias("runner_id"),
        ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int").alias("race_id"),
        month.alias("date"),
        F.col("o_totalprice"),
        F.col("o_orderpriority").alias("category"),
    )
    first = keep_first(raw, ["runner_id", "race_id"], "result_id")
    distance = (F.lit(5.0) + (F.col("race_id") % 16)).cast("double")
    time_sec = F.floor(F.col("distance") / (F.lit(6.0) + F.col("o_totalprice") / 50000.0) * 3600.0).cast("int")
    return (first
            .withColumn("year", F.year("date"))
            .withColumn("distance", distance)
            .withColumn("time_sec", time_sec)
            .withColumn("speed_kmh", F.col("distance") / (F.col("time_sec") / 3600.0))
            .drop("o_totalprice"))


def results(spark: SparkSession, sf_dir: str, with_positions: bool = True) -> DataFrame:
    """Results fact: result_id, runner_id, race_id, date, year, distance,
    time_sec, speed_kmh, category[, position, position_category]."""
    r = base_results(spark, sf_dir)
    if not with_positions:
        return r

    def build():
        return group_row_number(r, ["race_id"], ["time_sec", "result_id"], "position", within={"position_category": ["category"]})
    return stage_table(spark, f"results:{sf_dir}", build)


def dim_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    """race_id, racekey, name, distance, date, year -- one row per race."""
    r = base_results(spark, sf_dir)
    races = r.groupBy("race_id").agg(F.min("date").alias("date"), F.min("distance").alias("distance"))
    name = F.concat(F.lit("Course "), F.col("race_id").cast("string"))
    return races.select(
        "race_id",
        F.concat_ws("_", F.lower(F.trim(name)), F.col("date").cast("string"),
                    F.col("distance").cast("string")).alias("racekey"),
        name.alias("name"), "distance", "date", F.year("date").alias("year"))


def dim_runner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """runner_id, name_origin, name_clean, sex from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("runner_id"),
        F.col("c_name").alias("name_origin"),
        F.upper(F.col("c_name")).alias("name_clean"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("sex"))


# ---------------------------------------------------------------------------
# Raw (uncleaned) results, shaped like rows extracted from ranking documents.
# Every messy variant is derived from the row's key, so the table is
# deterministic and grows with the driver's data.
# ---------------------------------------------------------------------------

def _raw_categories():
    from ..operators.cleaning import CATEGORY_MAP
    return list(CATEGORY_MAP) + ["ZZZ"]


def with_people(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Each result's ``part`` and ``customer`` columns, by its runner.

    Both tables grow with the data while their compressed files stay small: Spark, which goes by the files' size,
    would collect them on the driver and send them out. Merge joins on the one key deal each side once.
    """
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("runner_id"), "p_name", "p_type")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("runner_id"), "c_mktsegment")
    return rows.join(p.hint("merge"), "runner_id", "left").join(c.hint("merge"), "runner_id", "left")


GARBLED_RACE_EVERY = 40  # races whose header gives a garbled course name


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_results(Position, Nom, Club, Sexe, Categorie, `Position Catégorie`, Temps,
    NomCourse, Date, Distance, source_file, racekey) -- all text except Date/Distance."""
    return stage_table(spark, f"raw_results:{sf_dir}", lambda: _raw_results(spark, sf_dir))


def _raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = results(spark, sf_dir)
    j = with_people(spark, sf_dir, r)
    rid = F.col("result_id")
    base = F.concat_ws(" ", "p_name", "p_type")
    nom = (F.when(rid % 101 == 0, F.lit("#N/A"))
            .when(rid % 103 == 0, F.concat((rid % 10).cast("string"), F.lit(" "), base))
            .when(rid % 107 == 0, F.concat(F.lit("(Cid:10)"), base))
            .when(rid % 109 == 0, F.lit(None).cast("string"))
            .when(rid % 5 == 1, F.concat(base, F.lit("  ")))
            .otherwise(base))
    sexe = (F.when(rid % 113 == 0, F.lit(None).cast("string"))
             .when(F.col("runner_id") % 2 == 0, F.lit("H")).otherwise(F.lit("F")))
    club = F.when(rid % 2 == 0, F.col("c_mktsegment")).when(rid % 3 == 0, F.lit("*")).otherwise(F.lit("-"))
    cats = _raw_categories()
    cat = F.element_at(F.array(*[F.lit(x) for x in cats], F.lit(None).cast("string")),
                       (rid % (len(cats) + 1)).cast("int") + 1)
    t = F.col("time_sec")
    h, m, s = F.floor(t / 3600), F.floor((t % 3600) / 60), t % 60
    std = F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).otherwise(F.format_string("%02d:%02d", m, s))
    temps = (F.when(rid % 89 == 0, F.lit("#VALEUR!"))
              .when(rid % 83 == 0, F.lit(None).cast("string"))
              .when(rid % 79 == 0, F.format_string("%d: %02d:%02d", h, m, s))
              .when(rid % 73 == 0, F.lit("1:2:3:4"))
              .when(rid % 71 == 0, F.lit("ab:cd"))
              .otherwise(std))
    course = F.when(F.col("race_id") % GARBLED_RACE_EVERY == 0,
                    F.concat(F.lit("Sef : "), F.col("race_id").cast("string"), F.lit(" Seh : 0"))) \
              .otherwise(F.concat(F.lit("Course "), F.col("race_id").cast("string")))
    position = F.when(rid % 127 == 0, F.lit("DNF")).otherwise(F.col("position").cast("string"))
    out = j.select(
        position.alias("Position"), nom.alias("Nom"), club.alias("Club"), sexe.alias("Sexe"),
        cat.alias("Categorie"), F.col("position_category").cast("string").alias("Position Catégorie"),
        temps.alias("Temps"), course.alias("NomCourse"), F.col("date").alias("Date"),
        F.col("distance").alias("Distance"),
        F.concat(F.date_format("date", "yyyyMMdd"), F.lit("-race-"), F.col("race_id").cast("string"),
                 F.lit(".pdf")).alias("source_file"))
    from ..operators.cleaning import race_key
    return out.withColumn("racekey", race_key("NomCourse", "Date", "Distance"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names adapter (from ``part``): one result row per part with a person-like name.

    base = upper(p_name || ' ' || p_type || ' ' || a word for every thousand parts), the first two
    twice when p_partkey % 10 = 3 (long names), so that names grow with the table; tokens reversed when p_partkey % 7 = 0,
    else the last-but-one character dropped when p_partkey % 13 = 0;
    Sexe = H/F by parity of length(p_name); speed = 8 + length(base) % 5 + p_size / 100;
    racekey = event p_partkey % 997.
    """
    p = table(spark, sf_dir, "part")
    word = F.translate(F.floor(F.col("p_partkey") / 1000).cast("string"), "0123456789", "ABCDEFGHIJ")
    twice = F.when(F.col("p_partkey") % 10 == 3, F.concat_ws(" ", "p_name", "p_type"))
    base = F.upper(F.concat_ws(" ", "p_name", "p_type", twice, word))
    n = F.length(base)
    nom = (F.when(F.col("p_partkey") % 7 == 0, F.array_join(F.reverse(F.split(base, " ")), " "))
            .when(F.col("p_partkey") % 13 == 0, F.concat(F.substring(base, 1, n - 2), F.substring(base, n, 1)))
            .otherwise(base))
    return p.select(
        F.col("p_partkey").alias("row_id"), nom.alias("Nom"),
        F.when(F.length("p_name") % 2 == 0, F.lit("H")).otherwise(F.lit("F")).alias("Sexe"),
        (F.lit(8.0) + (n % 5) + F.col("p_size") / 100.0).alias("speed_kmh"),
        F.concat(F.lit("e"), (F.col("p_partkey") % 997).cast("string")).alias("racekey"))
