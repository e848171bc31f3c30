"""Registered row-shredding queries on the documents adapter.

Oracle = round trip: the rows each layout must yield are derived directly from
the results the documents were generated from (not by re-parsing cells).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parse import CAT_MEN, CAT_WOMEN
from ..operators import shred as SH
from ..sources import documents as D
from .catalog import register
from .oracle import RESULTS_CTE, with_ctes
from .queries_cleaning import _title_sql

_cats = ", ".join(f"'{c}'" for c in D.DOC_CATEGORIES)


def _norm(x):
    return _title_sql(x)


def _sex(c):
    return (f"CASE WHEN regexp_full_match({c}, '{CAT_MEN[1:-1]}') THEN 'H' "
            f"WHEN regexp_full_match({c}, '{CAT_WOMEN[1:-1]}') THEN 'F' ELSE 'X' END")


DOC_CTE = f"""
rf AS (
  SELECT f.result_id AS rid, f.race_id, f.runner_id, f.position, f.position_category, f.distance,
         2006 + f.race_id % 20 AS season,
         make_date(2006 + f.race_id % 20, month(f.date), day(f.date)) AS doc_date,
         CAST(2006 + f.race_id % 20 AS VARCHAR) || strftime(f.date, '%m%d') || '-race-' || CAST(f.race_id AS VARCHAR) || '.pdf' AS source_file,
         p.p_name || ' ' || p.p_type AS nm, p.p_name AS first_part, p.p_type AS last_part,
         CASE WHEN f.result_id % 2 = 0 THEN c.c_mktsegment ELSE '*' END AS club,
         [{_cats}][CAST(f.result_id % 10 AS INTEGER) + 1] AS cat,
         printf('%02d:%02d:%02d', f.time_sec // 3600, (f.time_sec % 3600) // 60, f.time_sec % 60) AS temps,
         CASE WHEN f.runner_id % 2 = 0 THEN 'H' ELSE 'F' END AS sexe,
         (f.position - 1) // 40 + 1 AS page_no
  FROM results f LEFT JOIN part p ON p.p_partkey = f.runner_id LEFT JOIN customer c ON c.c_custkey = f.runner_id),
rl AS (SELECT *, CASE WHEN season <= 2007 THEN 'left' WHEN season = 2010 AND race_id % 3 = 0 THEN NULL
                      WHEN season <= 2016 THEN 'right' WHEN season <= 2024 THEN 'score' ELSE 'header' END AS layout,
              CASE WHEN season = 2010 AND race_id % 3 = 0 THEN 'no parser found'
                   WHEN season = 2006 AND race_id // 20 = 1 THEN 'malformed distance'
                   WHEN season = 2007 AND race_id // 20 = 2 THEN 'invalid date' END AS error
       FROM rf),
expected AS (
  SELECT source_file, CAST(position AS VARCHAR) AS "Position",
    CASE WHEN layout = 'right' AND rid % 11 = 0 THEN {_norm("nm || ' SE'")} ELSE {_norm('nm')} END AS "Nom",
    CASE WHEN layout = 'right' THEN (CASE WHEN rid % 11 <> 0 AND rid % 2 = 0 THEN {_norm('club')} END)
         WHEN {_norm('club')} IN ('*', '-') THEN '' ELSE {_norm('club')} END AS "Club",
    CASE WHEN layout = 'header' THEN sexe ELSE {_sex('cat')} END AS "Sexe",
    cat AS "Categorie", CAST(position_category AS VARCHAR) AS "Position Catégorie", temps AS "Temps",
    'Course ' || CAST(race_id AS VARCHAR) AS "NomCourse", doc_date AS "Date", distance AS "Distance",
    layout, race_id, page_no, rid
  FROM rl WHERE error IS NULL AND NOT (layout = 'score' AND (rid % 17 = 0 OR rid % 19 = 0)))
"""
_COLS = ('source_file, "Position", "Nom", "Club", "Sexe", "Categorie", "Position Catégorie", "Temps", '
         '"NomCourse", "Date", "Distance"')


def _docs(spark, sf):
    cells, pages = D.cells(spark, sf), D.page_text(spark, sf)
    return cells, pages, SH.file_headers(pages)


def _layout_sql(cond):
    return with_ctes(f"SELECT {_COLS} FROM expected WHERE {cond}", RESULTS_CTE, DOC_CTE)


@register("cells_layout_left", _layout_sql("layout = 'left'"), doubles=("Distance",))
def cells_layout_left(spark, sf):
    c, _p, h = _docs(spark, sf)
    return SH.parse_left(c, h)


@register("cells_layout_right", _layout_sql("layout = 'right'"), doubles=("Distance",))
def cells_layout_right(spark, sf):
    c, _p, h = _docs(spark, sf)
    return SH.parse_right(c, h)


@register("cells_layout_score", _layout_sql("layout = 'score'"), doubles=("Distance",))
def cells_layout_score(spark, sf):
    c, _p, h = _docs(spark, sf)
    return SH.parse_score(c, h)


@register("cells_layout_header", _layout_sql("layout = 'header' AND NOT ((race_id // 20) % 2 = 0 AND page_no % 2 = 0)"),
          doubles=("Distance",))
def cells_layout_header(spark, sf):
    c, _p, h = _docs(spark, sf)
    return SH.parse_header(c, h).drop("page_no")


@register("text_line_fallback", _layout_sql("layout = 'header' AND (race_id // 20) % 2 = 0 AND page_no % 2 = 0"),
          doubles=("Distance",))
def text_line_fallback(spark, sf):
    c, p, h = _docs(spark, sf)
    return SH.parse_text_lines(c, p, h)


_FILES = """files AS (SELECT source_file, race_id, any_value(layout) AS layout, any_value(error) AS error, any_value(doc_date) AS doc_date,
  any_value(distance) AS distance, count(*) AS n FROM rl GROUP BY source_file, race_id)"""


@register("layout_router", with_ctes("""
SELECT source_file, layout, CASE WHEN layout IS NOT NULL THEN 'Course ' || CAST(race_id AS VARCHAR) END AS "NomCourse",
       CASE WHEN error = 'invalid date' THEN NULL ELSE doc_date END AS "Date",
       CASE WHEN error = 'malformed distance' THEN NULL ELSE distance END AS "Distance",
       CAST(CASE WHEN layout IN ('right', 'score', 'header') THEN n END AS INTEGER) AS expected, error
FROM files""", RESULTS_CTE, DOC_CTE, _FILES), doubles=("Distance",))
def layout_router(spark, sf):
    _c, _p, h = _docs(spark, sf)
    return h


@register("reconcile_counts", with_ctes("""
SELECT fl.source_file AS file,
       CASE WHEN fl.error IS NOT NULL THEN 'FAILED'
            WHEN fl.layout IN ('right', 'score', 'header') AND coalesce(e.parsed, 0) <> fl.n THEN 'MISMATCH'
            ELSE 'OK' END AS status,
       coalesce(e.parsed, 0) AS rows, coalesce(e.parsed, 0) AS parsed,
       CAST(CASE WHEN fl.layout IN ('right', 'score', 'header') THEN fl.n END AS INTEGER) AS expected,
       fl.error FROM files fl LEFT JOIN (SELECT source_file, count(*) AS parsed FROM expected GROUP BY 1) e USING (source_file)""",
                                         RESULTS_CTE, DOC_CTE, _FILES))
def reconcile_counts(spark, sf):
    c, p, _h = _docs(spark, sf)
    out = SH.shred(c, p)
    return SH.reconcile(out["rows"], out["headers"])


@register("parse_report", with_ctes("""
SELECT status, count(*) AS files, CAST(coalesce(sum(parsed), 0) AS BIGINT) AS rows FROM (
  SELECT CASE WHEN fl.error IS NOT NULL THEN 'FAILED'
              WHEN fl.layout IN ('right', 'score', 'header') AND coalesce(e.parsed, 0) <> fl.n THEN 'MISMATCH'
              ELSE 'OK' END AS status,
         coalesce(e.parsed, 0) AS parsed
  FROM files fl LEFT JOIN (SELECT source_file, count(*) AS parsed FROM expected GROUP BY 1) e USING (source_file)) q
GROUP BY status""", RESULTS_CTE, DOC_CTE, _FILES))
def parse_report(spark, sf):
    c, p, _h = _docs(spark, sf)
    out = SH.shred(c, p)
    return SH.parse_report(SH.reconcile(out["rows"], out["headers"]))


_TEXT = """
heads AS (SELECT source_file, race_id, season, n, doc_date,
    CASE WHEN error = 'malformed distance' THEN '1.2.3' ELSE replace(printf('%.1f', distance), '.', ',') END AS dist,
    CASE WHEN error = 'invalid date' THEN '32' ELSE CAST(day(doc_date) AS VARCHAR) END AS d,
    'Course ' || CAST(race_id AS VARCHAR) AS course
  FROM (SELECT source_file, race_id, season, error, doc_date, distance, count(*) AS n FROM rl GROUP BY ALL)),
tops AS (SELECT source_file, CASE WHEN season = 2025 THEN
      concat_ws(chr(10), course || ' ' || season, 'Distance ' || dist || ' km', 'Nombre de classés : ' || n, 'www.goaltiming.be',
                'Rank Dos Nom Sexe Club Cat Pl/Cat Temps')
    ELSE concat_ws(chr(10), 'RESULTATS', course || ' ' || season, course || ' SEF : 3 V1 : 2 DISTANCE : ' || dist || ' km',
                concat_ws(' ', ['dimanche', 'lundi', 'mardi', 'mercredi', 'jeudi', 'vendredi', 'samedi'][dayofweek(doc_date) + 1], d,
                          ['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre',
                           'décembre'][month(doc_date)], season),
                CASE WHEN season >= 2008 THEN 'Nombre de participants arrivés : ' || n END,
                CASE WHEN season >= 2017 OR (season = 2010 AND race_id % 3 = 0) THEN 'http://results.example.org' END) END AS top
  FROM heads)"""


@register("document_text", with_ctes("""
SELECT source_file, max(page_no) AS pages, md5(any_value(top) || chr(10) || string_agg(
         concat_ws(' ', position, rid, first_part, last_part, sexe, club, cat, position_category, temps), chr(10) ORDER BY position)) AS text_md5
FROM rl JOIN tops USING (source_file) GROUP BY source_file""", RESULTS_CTE, DOC_CTE, _TEXT))
def document_text(spark, sf):
    """Every document assembled from its pages in order, as a hash of its whole text."""
    pages = D.page_text(spark, sf)
    d = SH.document_text(pages).select("source_file", F.md5(F.col("full_text").cast("binary")).alias("text_md5"))
    return d.join(pages.groupBy("source_file").agg(F.max("page_no").cast("long").alias("pages")), "source_file")
