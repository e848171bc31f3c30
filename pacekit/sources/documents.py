"""Documents adapter: results -> extracted ranking tables (cells) and page text.

Each race becomes one document.  Its season year (2006 + race_id % 20) picks
the layout the text announces, so all four table layouts, the router's gaps,
headerless continuation tables and the text-line fallback are exercised:

  2006-07  fixed-left cells, optional bib          (rank, [bib], name, club, cat, rank_cat, time)
  2008-16  right-anchored cells, split name, optional club, sometimes a category as last middle cell
  2017-24  fixed cells, bib, sometimes a score column before the time; cat '1' rows and names with '/'
  2025     header-located cells (header only on page 1); every other cycle has its even pages in the text layer only
  2010 with race_id % 3 == 0 also mentions http: no layout accepts it (FAILED)
  the second 2006 document has a malformed distance, the third 2007 one a date that does not exist (FAILED)

Every page has its result lines in the text layer; the first page begins with the document's header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table
from . import adapters

ROWS_PER_PAGE = 40
# Categories used by the documents (all known to the fallback pattern) and weekdays.
DOC_CATEGORIES = ["SH", "SD", "V1", "V2", "A1", "A2", "ESH", "ESF", "JH", "JF"]
HEADER_CELLS = ["Rank", "Dos", "Nom", "", "Sexe", "Club", "Cat", "Pl/Cat", "Temps"]
_MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre",
           "novembre", "décembre"]
_DAYS = ["dimanche", "lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi"]  # by dayofweek


def text_only(race_id, page_no):
    """Pages of 2025 documents that exist in the text layer only: the even ones, every other 20-race cycle."""
    return (F.floor(race_id / 20) % 2 == 0) & (page_no % 2 == 0)


def _season(race_id):
    return (F.lit(2006) + race_id % 20).cast("int")


def result_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per result the raw values a ranking document shows."""
    r = adapters.results(spark, sf_dir)
    j = adapters.with_people(spark, sf_dir, r)
    rid = F.col("result_id")
    t = F.col("time_sec")
    season = _season(F.col("race_id"))
    doc_date = F.make_date(season, F.month("date"), F.dayofmonth("date"))
    return j.select(
        "result_id", "race_id", "runner_id", "position", "position_category", "distance",
        season.alias("season"), doc_date.alias("doc_date"),
        F.concat(season.cast("string"), F.date_format("date", "MMdd"), F.lit("-race-"),
                 F.col("race_id").cast("string"), F.lit(".pdf")).alias("source_file"),
        F.col("p_name").alias("first_part"), F.col("p_type").alias("last_part"),
        F.when(rid % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit("*")).alias("club"),
        F.element_at(F.array(*[F.lit(x) for x in DOC_CATEGORIES]), (rid % 10).cast("int") + 1).alias("cat"),
        F.format_string("%02d:%02d:%02d", F.floor(t / 3600), F.floor((t % 3600) / 60), t % 60).alias("temps"),
        F.when(F.col("runner_id") % 2 == 0, F.lit("H")).otherwise(F.lit("F")).alias("sexe"),
        (F.floor((F.col("position") - 1) / ROWS_PER_PAGE) + 1).cast("int").alias("page_no"),
        rid.alias("rid"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted table rows: source_file, page_no, table_no, row_no, cells ARRAY<STRING>."""
    return stage_table(spark, f"cells:{sf_dir}", lambda: _cells(spark, sf_dir))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = result_fields(spark, sf_dir)
    rid, season = F.col("rid"), F.col("season")
    rank, rank_cat = F.col("position").cast("string"), F.col("position_category").cast("string")
    bib = F.when(rid % 3 != 0, rid.cast("string"))
    name = F.concat_ws(" ", "first_part", "last_part")
    arr = lambda *xs: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    left = F.when(bib.isNotNull(), arr(rank, bib, name, F.col("club"), F.col("cat"), rank_cat, F.col("temps"))) \
            .otherwise(arr(rank, name, F.col("club"), F.col("cat"), rank_cat, F.col("temps")))
    start = F.when(bib.isNotNull(), arr(rank, bib)).otherwise(arr(rank))
    tail = arr(F.col("cat"), rank_cat, F.col("temps"), F.lit("5:00"), F.lit("12.0"))
    middle = (F.when(rid % 11 == 0, arr(F.col("first_part"), F.col("last_part"), F.lit("SE")))
               .when(rid % 2 == 0, arr(F.col("first_part"), F.col("last_part"), F.col("club")))
               .otherwise(arr(name)))
    right = F.concat(start, middle, tail)
    cat4 = F.when(rid % 17 == 0, F.lit("1")).otherwise(F.col("cat"))
    name4 = F.when(rid % 19 == 0, F.concat(name, F.lit("/X"))).otherwise(name)
    score = F.when(rid % 5 == 0, arr(rank, rid.cast("string"), name4, F.col("club"), cat4, rank_cat, F.lit("87"),
                                     F.col("temps"))) \
             .otherwise(arr(rank, rid.cast("string"), name4, F.col("club"), cat4, rank_cat, F.col("temps")))
    header = arr(rank, rid.cast("string"), F.col("first_part"), F.col("last_part"), F.col("sexe"), F.col("club"),
                 F.col("cat"), rank_cat, F.col("temps"))
    s = season
    cells_col = (F.when(s <= 2007, left).when(s <= 2016, right).when(s <= 2024, score).otherwise(header))
    data = f.select("source_file", "page_no", F.lit(1).alias("table_no"),
                    (F.col("position") - (F.col("page_no") - 1) * ROWS_PER_PAGE).cast("int").alias("row_no"),
                    cells_col.alias("cells"), "season", "race_id")
    data = data.where(~((F.col("season") == 2025) & text_only(F.col("race_id"), F.col("page_no"))))
    files = f.select("source_file", "season").distinct()
    head = files.select("source_file", F.lit(1).alias("page_no"), F.lit(1).alias("table_no"), F.lit(0).alias("row_no"),
                        F.when(F.col("season") == 2025, F.array(*[F.lit(x) for x in HEADER_CELLS]))
                         .otherwise(F.array(F.lit("Pl."), F.lit("Dos"), F.lit("Nom"), F.lit("Club")))
                         .alias("cells"))
    return data.drop("season", "race_id").unionByName(head)


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text layer: source_file, page_no, text."""
    return stage_table(spark, f"page_text:{sf_dir}", lambda: _page_text(spark, sf_dir))


def _page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = result_fields(spark, sf_dir)
    files = f.groupBy("source_file", "race_id", "season", "doc_date", "distance").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_no").alias("pages"))
    rid, season = F.col("race_id"), F.col("season")
    course = F.concat(F.lit("Course "), rid.cast("string"))
    cycle = F.floor(rid / 20)
    dist = F.when((season == 2006) & (cycle == 1), F.lit("1.2.3")).otherwise(
        F.regexp_replace(F.format_string("%.1f", F.col("distance")), r"\.", ","))
    weekday = F.element_at(F.array(*[F.lit(d) for d in _DAYS]), F.dayofweek("doc_date"))  # 1 = sunday
    month = F.element_at(F.array(*[F.lit(m) for m in _MONTHS]), F.month("doc_date"))
    date_txt = F.concat_ws(" ", weekday, F.when((season == 2007) & (cycle == 2), F.lit("32")).otherwise(F.dayofmonth("doc_date").cast("string")), month, season.cast("string"))
    http = (season >= 2017) | ((season == 2010) & (rid % 3 == 0))
    classic = F.concat_ws("\n", F.lit("RESULTATS"), F.concat(course, F.lit(" "), season.cast("string")),
                          F.concat(course, F.lit(" SEF : 3 V1 : 2 DISTANCE : "), dist, F.lit(" km")),
                          date_txt,
                          F.when(season >= 2008, F.concat(F.lit("Nombre de participants arrivés : "),
                                                          F.col("n").cast("string"))),
                          F.when(http, F.lit("http://results.example.org")))
    modern = F.concat_ws("\n", F.concat(course, F.lit(" "), season.cast("string")),
                         F.concat(F.lit("Distance "), dist, F.lit(" km")),
                         F.concat(F.lit("Nombre de classés : "), F.col("n").cast("string")),
                         F.lit("www.goaltiming.be"), F.lit("Rank Dos Nom Sexe Club Cat Pl/Cat Temps"))
    head = files.select("source_file", F.when(season == 2025, modern).otherwise(classic).alias("head"))
    # result lines: rank bib name sex club cat rank_cat time; a page has at most ROWS_PER_PAGE
    line = F.concat_ws(" ", F.col("position").cast("string"), F.col("rid").cast("string"), "first_part", "last_part",
                       "sexe", "club", "cat", F.col("position_category").cast("string"), "temps")
    body = f.select("source_file", "page_no", "position", line.alias("line")).groupBy("source_file", "page_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "line"))), lambda x: x["line"]), "\n").alias("body"))
    return body.join(head, "source_file").select("source_file", "page_no", F.when(
        F.col("page_no") == 1, F.concat_ws("\n", "head", "body")).otherwise(F.col("body")).alias("text"))
