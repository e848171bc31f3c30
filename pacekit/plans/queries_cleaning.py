"""Registered cleaning queries on the raw-results adapter."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions import text as T
from ..operators import cleaning as C
from ..sources import adapters
from .catalog import register
from .oracle import RAW_CTE, RESULTS_CTE, with_ctes

# Override rules for the adapter's data (same shapes as the reference's:
# two course-name fixes, file -> distance fixes with one file listed twice, and a
# compound name/sex rule plus a prefixed-name fix).
ADAPTER_OVERRIDES = [
    C.Override("NomCourse", "Sef : 40 Seh : 0", "NomCourse", "Course 40"),
    C.Override("NomCourse", "Sef : 80 Seh : 0", "NomCourse", "Course 80"),
    C.Override("source_file", "19950701-race-7.pdf", "Distance", 7.5),
    C.Override("source_file", "19960301-race-15.pdf", "Distance", 15.2),
    C.Override("source_file", "19950701-race-7.pdf", "Distance", 7.5),
    C.Override("Nom", "blue bolt SMALL", "Club", "Override Club", cond_col="Sexe", cond_not="F"),
    C.Override("Nom", "blue bolt SMALL", "Sexe", "F", cond_col="Sexe", cond_not="F"),
    C.Override("Nom", "(Cid:10)small ring ECONOMY", "Nom", "small ring ECONOMY"),
]

_CATMAP = "catmap AS (SELECT * FROM (VALUES " + ", ".join(
    "('" + k.replace("'", "''") + "', '" + v + "')" for k, v in C.CATEGORY_MAP.items()) + ") m(raw, code))"


def _dur_sql(col):
    t = f"CASE WHEN trim({col}) = '#VALEUR!' THEN NULL ELSE replace(trim({col}), ' ', '') END"
    parts = f"string_split({t}, ':')"
    n = f"len({parts})"
    def pick(i3, i2):
        x = f"CASE WHEN {n} = 3 THEN {parts}[{i3}] WHEN {n} = 2 THEN {i2} END"
        return f"(CASE WHEN ({x}) = '' THEN '0' ELSE ({x}) END)"
    hh, mm, ss = pick(1, "'0'"), pick(2, f"{parts}[1]"), pick(3, f"{parts}[2]")
    ok = (f"(regexp_full_match({hh}, '\\d+') AND regexp_full_match({mm}, '\\d+') "
          f"AND regexp_full_match({ss}, '\\d+(\\.\\d+)?'))")
    return (f"CAST(CASE WHEN {ok} THEN TRY_CAST({hh} AS BIGINT) * 3600 + TRY_CAST({mm} AS BIGINT) * 60 "
            f"+ floor(TRY_CAST({ss} AS DECIMAL(20,9))) END AS INTEGER)")


def _title_sql(col):
    collapsed = f"trim(regexp_replace({col}, '\\s+', ' ', 'g'))"
    return (f"strip_accents(array_to_string(list_transform(regexp_extract_all({collapsed}, '(\\p{{L}}+|\\P{{L}}+)', 1), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ''))")


def _key_sql(col):
    return f"coalesce(trim(regexp_replace(regexp_replace(upper({col}), '[^A-Z\\s]', ' ', 'g'), '\\s+', ' ', 'g')), '')"


def _block_sql(key):
    return (f"array_to_string(list_transform(list_sort(list_filter(string_split({key}, ' '), lambda t: t <> '')), "
            f"lambda t: t[1:3]), '')")


def _raw(spark, sf):
    return adapters.raw_results(spark, sf)


@register("category_map", with_ctes("""
SELECT source_file, "Position", "Categorie", categorie_cleaned,
       CASE WHEN categorie_cleaned = 'XXX' THEN '0' ELSE "Position Catégorie" END AS "Position Catégorie"
FROM (SELECT r.*, coalesce(m.code, 'XXX') AS categorie_cleaned FROM raw_keyed r LEFT JOIN catmap m ON m.raw = r."Categorie") q
""", RESULTS_CTE, RAW_CTE, _CATMAP))
def category_map(spark, sf):
    df = C.reset_rank_for_unknown(C.harmonise_category(_raw(spark, sf)))
    return df.select("source_file", "Position", "Categorie", "categorie_cleaned", C.POS_CAT)


@register("duration_parse", with_ctes(f"""
SELECT "Temps", {_dur_sql('"Temps"')} AS temps_sec FROM raw_keyed""", RESULTS_CTE, RAW_CTE))
def duration_parse(spark, sf):
    return _raw(spark, sf).select("Temps", P.duration_seconds("Temps").alias("temps_sec"))


@register("title_case_names", with_ctes(f"""
SELECT "Nom", {_title_sql('"Nom"')} AS nom_title, {_title_sql('"NomCourse"')} AS course_title FROM raw_keyed""",
                                        RESULTS_CTE, RAW_CTE))
def title_case_names(spark, sf):
    return _raw(spark, sf).select("Nom", T.normalize_name("Nom").alias("nom_title"),
                                  T.normalize_course_name("NomCourse").alias("course_title"))


@register("match_key", with_ctes(f"""
SELECT "Nom", match_key, {_block_sql('match_key')} AS blocking_key
FROM (SELECT "Nom", {_key_sql('"Nom"')} AS match_key FROM raw_keyed) q""", RESULTS_CTE, RAW_CTE))
def match_key(spark, sf):
    df = _raw(spark, sf).select("Nom", T.match_key("Nom").alias("match_key"))
    return df.withColumn("blocking_key", T.blocking_key("match_key"))


@register("race_key", with_ctes("""
SELECT DISTINCT "NomCourse", "Date", "Distance", racekey FROM raw_keyed""", RESULTS_CTE, RAW_CTE),
          doubles=("Distance",))
def race_key(spark, sf):
    return _raw(spark, sf).select("NomCourse", "Date", "Distance", "racekey").distinct()


@register("pattern_violations", with_ctes("""
SELECT DISTINCT "Temps" FROM raw_keyed
WHERE "Temps" IS NOT NULL AND NOT regexp_full_match("Temps", '\\d{1,2}:\\d{2}(:\\d{2})?')""", RESULTS_CTE, RAW_CTE))
def pattern_violations(spark, sf):
    t = _raw(spark, sf).select("Temps").where(F.col("Temps").isNotNull())
    return t.where(~F.col("Temps").rlike(r"^\d{1,2}:\d{2}(:\d{2})?$")).distinct()


def cleaned(spark, sf):
    """W12 dedup, then the cleaning steps with the adapter's override rules."""
    return C.clean_results(C.dedup_results(_raw(spark, sf)), ADAPTER_OVERRIDES)


_CLEAN_SQL_CTES = f"""
dedup AS (SELECT * FROM raw_keyed QUALIFY row_number() OVER (PARTITION BY racekey, "Nom" ORDER BY source_file, "Position") = 1),
c1 AS (SELECT d.*, coalesce(m.code, 'XXX') AS categorie_cleaned FROM dedup d LEFT JOIN catmap m ON m.raw = d."Categorie"),
c2 AS (SELECT * REPLACE (CASE WHEN categorie_cleaned = 'XXX' THEN '0' ELSE "Position Catégorie" END AS "Position Catégorie") FROM c1),
c3 AS (SELECT *, TRY_CAST("Position" AS INTEGER) AS _p, TRY_CAST("Position Catégorie" AS INTEGER) AS _pc FROM c2),
c3b AS (SELECT * EXCLUDE (_p, _pc) REPLACE (_p AS "Position", _pc AS "Position Catégorie") FROM c3
        WHERE NOT ((_p IS NULL AND "Position" IS NOT NULL) OR (_pc IS NULL AND "Position Catégorie" IS NOT NULL))),
c4 AS (SELECT *, {_dur_sql('"Temps"')} AS temps_sec FROM c3b),
c5 AS (SELECT * REPLACE (
          CASE WHEN "NomCourse" = 'Sef : 80 Seh : 0' THEN 'Course 80'
               WHEN "NomCourse" = 'Sef : 40 Seh : 0' THEN 'Course 40' ELSE "NomCourse" END AS "NomCourse",
          CASE WHEN source_file = '19950701-race-7.pdf' THEN 7.5::DOUBLE
               WHEN source_file = '19960301-race-15.pdf' THEN 15.2::DOUBLE ELSE "Distance" END AS "Distance")
       FROM c4 WHERE temps_sec IS NOT NULL),
c6 AS (SELECT * FROM c5 WHERE NOT coalesce(regexp_matches("Nom", '^\\d'), false) AND NOT coalesce("Nom" = '#N/A', false)),
clean AS (SELECT * REPLACE (
          CASE WHEN "Nom" = 'blue bolt SMALL' AND "Sexe" IS DISTINCT FROM 'F' THEN 'Override Club' ELSE "Club" END AS "Club",
          CASE WHEN "Nom" = 'blue bolt SMALL' AND "Sexe" IS DISTINCT FROM 'F' THEN 'F' ELSE "Sexe" END AS "Sexe",
          CASE WHEN "Nom" = '(Cid:10)small ring ECONOMY' THEN 'small ring ECONOMY' ELSE "Nom" END AS "Nom")
       FROM c6)"""

CLEAN_CTES = (RESULTS_CTE, RAW_CTE, _CATMAP, _CLEAN_SQL_CTES)


@register("clean_table", with_ctes("SELECT * FROM clean", *CLEAN_CTES), doubles=("Distance",))
def clean_table(spark, sf):
    return cleaned(spark, sf).drop("temps_clean")


@register("overrides", with_ctes("""
SELECT "Nom", "Club", "Sexe", "NomCourse", source_file, "Distance" FROM clean
WHERE "Nom" IN ('blue bolt SMALL', 'small ring ECONOMY') OR source_file IN ('19950701-race-7.pdf', '19960301-race-15.pdf')
   OR "NomCourse" IN ('Course 40', 'Course 80')""", *CLEAN_CTES), doubles=("Distance",))
def overrides(spark, sf):
    c = cleaned(spark, sf)
    return c.where(F.col("Nom").isin("blue bolt SMALL", "small ring ECONOMY")
                   | F.col("source_file").isin("19950701-race-7.pdf", "19960301-race-15.pdf")
                   | F.col("NomCourse").isin("Course 40", "Course 80")) \
            .select("Nom", "Club", "Sexe", "NomCourse", "source_file", "Distance")


@register("quarantine", with_ctes("""
SELECT source_file, "Nom", "Position" FROM c3
WHERE (_p IS NULL AND "Position" IS NOT NULL) OR (_pc IS NULL AND "Position Catégorie" IS NOT NULL)""", *CLEAN_CTES))
def quarantine(spark, sf):
    df = C.reset_rank_for_unknown(C.harmonise_category(C.dedup_results(_raw(spark, sf))))
    _good, bad = C.cast_ints(df)
    return bad.select("source_file", "Nom", F.col("_raw_0").alias("Position"))
