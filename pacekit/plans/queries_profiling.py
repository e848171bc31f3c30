"""Registered profiling queries on the cleaned results."""

from __future__ import annotations

from ..sources import adapters, warehouse as WH
from . import profiling as PR
from .catalog import register
from .oracle import RESULTS_CTE, with_ctes
from .queries_cleaning import CLEAN_CTES, _key_sql, cleaned

DERIVED = f"""dv AS (SELECT *, "Distance" / NULLIF(temps_sec / 3600.0::DOUBLE, 0) AS speed_kmh,
  CAST(year("Date") AS INTEGER) AS year, {_key_sql('"Nom"')} AS "Nom_clean" FROM clean)"""
C = (*CLEAN_CTES, DERIVED)


def _dv(spark, sf):
    return PR.with_derived(cleaned(spark, sf))


@register("value_counts", with_ctes("""SELECT "Nom_clean", count(*) AS n FROM dv GROUP BY 1""", *C))
def value_counts(spark, sf):
    return PR.value_counts(_dv(spark, sf), "Nom_clean")


@register("count_of_counts", with_ctes("""
SELECT n_results, count(*) AS n_values FROM (SELECT "Nom_clean", count(*) AS n_results FROM dv GROUP BY 1) q
GROUP BY 1""", *C))
def count_of_counts(spark, sf):
    return PR.count_of_counts(_dv(spark, sf), "Nom_clean")


_NUM = ["temps_sec", "Distance", "speed_kmh"]


@register("describe_numeric", with_ctes(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, quantile_cont({c}::DOUBLE, 0.25) AS p25,
       quantile_cont({c}::DOUBLE, 0.5) AS p50, quantile_cont({c}::DOUBLE, 0.75) AS p75 FROM dv"""
                                                             for c in ['temps_sec', '"Distance"', 'speed_kmh']), *C)
          .replace("'\"Distance\"'", "'Distance'"),
          doubles=("mean", "std", "min", "max", "p25", "p50", "p75"))
def describe_numeric(spark, sf):
    return PR.describe_numeric(_dv(spark, sf), _NUM)


_TXT = ["Nom", "Club", "Sexe", "categorie_cleaned"]


@register("describe_text", with_ctes(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, sum(n)::BIGINT AS count, count(*) AS "unique",
       arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT "{c}" AS v, count(*) AS n FROM dv WHERE "{c}" IS NOT NULL GROUP BY 1) q""" for c in _TXT), *C))
def describe_text(spark, sf):
    return PR.describe_text(_dv(spark, sf), _TXT)


@register("distinct_per_year", with_ctes("""
SELECT year, count(*) AS rows, count(DISTINCT "Nom") AS distinct_nom, count(DISTINCT "NomCourse") AS distinct_nomcourse
FROM dv GROUP BY year""", *C))
def distinct_per_year(spark, sf):
    return PR.distinct_per_group(_dv(spark, sf), "year", ["Nom", "NomCourse"])


@register("active_entities", with_ctes("""
SELECT "Nom_clean", count(*) AS n, min("Distance") AS min_distance, avg("Distance") AS mean_distance,
       max("Distance") AS max_distance
FROM dv WHERE "Nom_clean" IN (SELECT "Nom_clean" FROM dv GROUP BY 1 HAVING count(*) >= 3) GROUP BY 1""", *C),
          doubles=("min_distance", "mean_distance", "max_distance"))
def active_entities(spark, sf):
    return PR.active_entities(_dv(spark, sf), "Nom_clean", "Distance")


@register("inconsistent_attribute", with_ctes("""
SELECT "Nom_clean", "Sexe", "Date", "NomCourse" FROM dv
WHERE "Nom_clean" IN (SELECT "Nom_clean" FROM dv GROUP BY 1 HAVING count(DISTINCT "Sexe") > 1)""", *C))
def inconsistent_attribute(spark, sf):
    return PR.inconsistent_attribute(_dv(spark, sf), "Nom_clean", "Sexe", ["Date", "NomCourse"])


@register("histogram", with_ctes("""
SELECT bin, mn + (mx - mn) * bin / 50.0::DOUBLE AS lower, mn + (mx - mn) * (bin + 1) / 50.0::DOUBLE AS upper,
       count(*) AS count
FROM (SELECT CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((c - mn) * 50 / CAST(mx - mn AS DOUBLE)), 49) END AS INTEGER) AS bin,
             mn, mx
      FROM (SELECT c, min(c) OVER () AS mn, max(c) OVER () AS mx
            FROM (SELECT "Nom_clean", count(*) AS c FROM dv GROUP BY 1) a) b) q
GROUP BY bin, mn, mx""", *C), doubles=("lower", "upper"))
def histogram(spark, sf):
    counts = PR.value_counts(_dv(spark, sf), "Nom_clean").withColumnRenamed("n", "c")
    return PR.histogram(counts, "c", 50)


@register("shape_profile", with_ctes(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, '{t}' AS type, count("{c}") AS non_null, count(*) AS rows FROM dv""" for c, t in [
    ("Position", "int"), ("Nom", "string"), ("Club", "string"), ("Sexe", "string"), ("Categorie", "string"),
    ("Position Catégorie", "int"), ("Temps", "string"), ("NomCourse", "string"), ("Date", "date"),
    ("Distance", "double"), ("source_file", "string"), ("racekey", "string"), ("categorie_cleaned", "string"),
    ("temps_sec", "int"), ("speed_kmh", "double"), ("year", "int"), ("Nom_clean", "string")]), *C))
def shape_profile(spark, sf):
    return PR.shape_profile(_dv(spark, sf).drop("temps_clean"))


@register("membership_filters", with_ctes("""
SELECT categorie_cleaned,
       count(*) FILTER (WHERE coalesce(categorie_cleaned IN ('SH', 'SD'), false) AND "Sexe" IS DISTINCT FROM 'F') AS in_list_not_value,
       count(*) FILTER (WHERE NOT coalesce(categorie_cleaned IN ('SH', 'SD'), false)) AS not_in_list
FROM dv GROUP BY 1""", *C))
def membership_filters(spark, sf):
    return PR.membership_filters(_dv(spark, sf), "categorie_cleaned", ["SH", "SD"], "Sexe", "F")


@register("sketched_runners", with_ctes("""
SELECT year, count(DISTINCT runner_id) AS exact, true AS within FROM results GROUP BY year
UNION ALL SELECT NULL, count(DISTINCT runner_id), true FROM results""", RESULTS_CTE))
def sketched_runners(spark, sf):
    """Runners per year from sketches stored a row per year, and over all years from their union."""
    rows, root = adapters.results(spark, sf, with_positions=False), WH.new_warehouse(spark)
    stored = WH.replace_table(spark, root, "runner_sketches", PR.distinct_sketches(rows, "year", "runner_id"))
    return PR.sketched_distinct(stored, rows, "year", "runner_id")
