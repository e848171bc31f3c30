"""Row shredding and record validation over extracted cells.

The reference parses each document in a Python loop. Here a layout is one struct-valued expression over a
row's ``cells ARRAY<STRING>``: NULL where the row is no result, else its fields. :func:`shred` evaluates all of
them in one pass: cells and page texts are dealt by document once; the header map that headerless tables
carry forward, and the pages without any parsed row whose text is read instead, are windows over that
one exchange; the per-document counts of the reconciliation need no further one. ``parse_*`` run one layout alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import (cell, cells_between, extract_date, extract_distance, extract_year, filename_date,
                               has_distance, header_index, invalid_date, is_time_like, sex_from_category)
from ..functions.text import normalize_course_name, normalize_name
from ..session import cut_lineage
from .cleaning import POS_CAT, race_key

# Categories that may sit in the last middle cell of the right-anchored layout.
RIGHT_LAYOUT_CATEGORIES = ["ESF", "SEF", "V1F", "V2F", "V3F", "V4F", "ESH", "SEH", "V1H", "V2H", "V3H", "V4H",
                           "xxx", "XXX", "ED", "DA", "A1", "A2", "A3", "A4", "EH", "SE", "V1", "V2", "V3", "V4",
                           "DAM", "AI1", "AI2", "AI3", "AI4", "ESP", "SEN"]
# Header keywords per column of the header-located layout.
HEADER_COLUMNS = [("rank", ["Rank"]), ("dos", ["Dos"]), ("nom", ["Nom"]), ("sexe", ["Sexe", "exe"]),
                  ("club", ["Club"]), ("cat", ["Cat"]), ("rank_cat", ["Pl/Cat"]), ("temps", ["Temps"])]
# Where counters begin in a course line, the fallback's categories, the layouts' markers and counts.
COUNTER_SPLIT = r"\s+(?:DA|A\d|SE|V\d|ED|EH|ESF|ESP|JUF|JUH|SEF|SD)\s*:"
FALLBACK_CATEGORY = r"^(SH|SD|V\d|A\d|ESF|ESH|JH|JF)$"
LAYOUT_MARKERS = ["goaltiming.be", "Rank", "Nom"]
PARTICIPANTS = r"(?i)Nombre de participants arriv[é]s\s*:\s*(\d+)"
CLASSIFIED = r"(?i)Nombre de class[ée]s\s*:\s*(\d+)"
OUT_COLUMNS = ["source_file", "Position", "Nom", "Club", "Sexe", "Categorie", POS_CAT, "Temps", "NomCourse",
               "Date", "Distance"]


def _digits(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d+$"), F.lit(False))


def _club(c: Column) -> Column:
    """V9 after F4: a normalised '*' or '-' becomes ''.  Normalisation keeps those
    characters, so testing the collapsed raw text is equivalent and cheaper."""
    raw = F.regexp_replace(F.trim(c), r"\s+", " ")
    return F.when(raw.isin("*", "-"), F.lit("")).otherwise(normalize_name(c))


def document_text(pages: DataFrame) -> DataFrame:
    """Whole text per document (pages in order, joined by newline) and the first page's text."""
    return pages.groupBy("source_file").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("t")))),
                                 lambda x: x["t"]), "\n").alias("full_text"),
        F.min_by("text", "page_no").alias("first_text"))


def route(year: Column, distance: Column, http: Column, modern: Column) -> Column:
    """V1: first layout whose condition holds, else NULL (the file fails)."""
    return (F.when(year.isin(2006, 2007), F.lit("left"))
             .when(distance.isNull(), F.lit(None).cast("string"))          # malformed distance fails the file
             .when(year.between(2008, 2016) & (distance > 2) & ~http, F.lit("right"))
             .when(year.between(2016, 2024) & (distance > 2) & http, F.lit("score"))
             .when(modern, F.lit("header")))


def document_facts(pages: DataFrame) -> DataFrame:
    """What routing needs of a document's text, aggregated page by page (no document is assembled)."""
    t, page = F.coalesce("text", F.lit("")), F.col("page_no")
    year, marker = extract_year(t), LAYOUT_MARKERS
    return pages.groupBy("source_file").agg(
        F.min_by("text", "page_no").alias("first_text"),
        F.coalesce(F.min_by(year, F.when(year != 0, page)), F.lit(0)).alias("_year"),
        F.when(F.max(has_distance(t)), F.min_by(extract_distance(t), F.when(has_distance(t), page))).otherwise(0.0).alias("_distance"),
        F.max(t.contains("http")).alias("_http"),
        (F.max(F.lower(t).contains(marker[0])) & F.max(t.contains(marker[1])) & F.max(t.contains(marker[2]))).alias("_modern"))


def file_headers(pages: DataFrame) -> DataFrame:
    """V1 + V7 (+ V8): layout, course name, date, distance and expected count per document, and
    why it fails: no layout, a malformed distance (F2) or a date that does not exist (F3)."""
    d = document_facts(pages).withColumn("layout", route(F.col("_year"), F.col("_distance"), F.col("_http"), F.col("_modern")))
    ft = F.col("first_text")
    classic_line = F.regexp_extract(ft, r"\n([^\n]+?)\s+DISTANCE", 1)
    score_line = F.regexp_extract(ft, r"(?i)\n([^\n]+?)\s+DISTANCE", 1)
    cut = lambda line: F.when(line == "", F.lit("UNKNOWN")).otherwise(F.trim(F.split(line, COUNTER_SPLIT)[0]))
    first_line = F.element_at(F.filter(F.transform(F.split(ft, "\n"), lambda x: F.trim(x)), lambda x: x != ""), 1)
    lay = F.col("layout")
    name = (F.when(lay == "left", normalize_course_name(F.split(ft, "\n")[1]))
             .when(lay == "right", normalize_course_name(cut(classic_line)))
             .when(lay == "score", normalize_course_name(cut(score_line)))
             .when(lay == "header", normalize_course_name(F.coalesce(first_line, F.lit("Inconnu")))))
    participants = F.regexp_extract(ft, PARTICIPANTS, 1)
    classes = F.regexp_extract(ft, CLASSIFIED, 1)
    expected = (F.when(lay.isin("right", "score") & (participants != ""), participants.cast("int"))
                 .when((lay == "header") & (classes != ""), classes.cast("int")))
    date = F.when(lay == "header", filename_date("source_file")).otherwise(extract_date(ft))
    error = (F.when(lay.isNull(), F.lit("no parser found"))
              .when(ft.isNotNull() & extract_distance(ft).isNull(), F.lit("malformed distance"))
              .when((lay != "header") & invalid_date(ft), F.lit("invalid date")))
    return d.select("source_file", "layout", name.alias("NomCourse"), date.alias("Date"),
                    extract_distance(ft).alias("Distance"), expected.alias("expected"), error.alias("error"))


_ROW = ["Position", "Nom", "Club", "Sexe", "Categorie", POS_CAT, "Temps"]


def _row(ok: Column, position: Column, nom: Column, club: Column, sexe: Column, categorie: Column, pos_cat: Column, temps: Column) -> Column:
    """The fields of a result row where ``ok`` holds, else NULL."""
    fields = (position, nom, club, sexe, categorie, pos_cat, temps)
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(*[v.cast("string").alias(n) for n, v in zip(_ROW, fields)]))


def left_row(arr: Column) -> Column:
    """V2: fixed-left cells, one offset when the bib column is missing."""
    off = F.when(_digits(F.get(arr, 1)), 0).otherwise(1)
    g = lambda k: F.get(arr, F.lit(k) - off)
    return _row(_digits(F.get(arr, 0)) & is_time_like(g(6)), F.get(arr, 0), normalize_name(g(2)), _club(g(3)), sex_from_category(g(4)),
                g(4), g(5), g(6))


def right_row(arr: Column) -> Column:
    """V3: time / rank-in-category / category read from the right end; name and club in the middle."""
    n = F.size(arr)
    start = F.when(_digits(F.get(arr, 1)), 2).otherwise(1)
    middle = F.slice(arr, start + 1, F.greatest(n - 5 - start, F.lit(0)))
    last = F.try_element_at(middle, F.lit(-1))
    is_cat = F.coalesce(F.array_contains(F.array(*[F.lit(x) for x in RIGHT_LAYOUT_CATEGORIES]), last), F.lit(False))
    many = F.size(middle) > 1
    full = (F.when(many & ~is_cat, F.array_join(F.slice(middle, 1, F.size(middle) - 1), " "))
             .when(many, F.array_join(middle, " "))
             .otherwise(F.get(middle, 0)))
    category = F.try_element_at(arr, F.lit(-5))
    return _row(_digits(F.get(arr, 0)) & (F.size(middle) >= 1), F.get(arr, 0), normalize_name(full), F.when(many & ~is_cat, _club(last)),
                sex_from_category(category), category, F.try_element_at(arr, F.lit(-4)), F.try_element_at(arr, F.lit(-3)))


def score_row(arr: Column) -> Column:
    """V4: fixed cells; the time moves one cell right when a score column precedes it."""
    t6, category = F.get(arr, 6), F.get(arr, 4)
    return _row(_digits(F.get(arr, 0)) & ~F.coalesce(category == "1", F.lit(False)), F.get(arr, 0), normalize_name(F.get(arr, 2)),
                _club(F.get(arr, 3)), sex_from_category(category), category, F.get(arr, 5), F.when(is_time_like(t6), t6).otherwise(F.get(arr, 7)))


def header_row(arr: Column, m: Column) -> Column:
    """V5: cells found through the header map ``m``."""
    idx = lambda k: F.element_at(m, F.lit(k))
    at = lambda k: cell(arr, F.coalesce(idx(k), F.lit(-1)))
    return _row(_digits(at("rank")) & at("temps").rlike(r"^\d{2}:\d{2}:\d{2}"), at("rank"), normalize_name(cells_between(arr, idx("nom"), idx("sexe"))),
                _club(cells_between(arr, idx("club"), idx("cat"))), at("sexe"), at("cat"), at("rank_cat"), at("temps"))


def text_row(line: Column) -> Column:
    """V6: one line of a page's text."""
    def parse(p: Column) -> Column:
        tpos = F.array_position(F.transform(p, lambda x: x.rlike(r"^\d{2}:\d{2}:\d{2}")), True) - 1
        cpos = F.array_position(F.transform(p, lambda x, i: (i >= 5) & (i < tpos) & x.rlike(FALLBACK_CATEGORY)), True) - 1
        spos = F.array_position(F.transform(p, lambda x, i: (i >= 2) & (i < 6) & x.rlike(r"^(H|F)$")), True) - 1
        club = F.array_join(F.slice(p, spos + 2, F.greatest(cpos - spos - 1, F.lit(0))), " ")
        nom = F.array_join(F.slice(p, 3, F.greatest(spos - 2, F.lit(0))), " ")
        ok = (F.size(p) >= 8) & _digits(F.get(p, 0)) & (tpos >= 0) & (cpos >= 0) & (spos >= 0)
        return _row(ok, F.get(p, 0), normalize_name(nom), _club(club), F.get(p, spos.cast("int")), F.get(p, cpos.cast("int")),
                    F.get(p, cpos.cast("int") + 1), F.get(p, tpos.cast("int")))
    parts = F.filter(F.split(F.trim(line), r"\s+"), lambda x: x != "")
    return F.transform(F.array(parts), parse)[0]


def _named(layout: Column, r: Column) -> Column:
    """Which parsed rows have a name that counts: any in tables found by their header and in text lines; none that is
    empty or 0 in the others, in the score layout none with a slash."""
    nom = r["Nom"]
    some = nom.isNotNull() & ~nom.isin("", "0")
    return r.isNotNull() & F.when(layout == "header", F.lit(True)).when(layout == "score", some & ~nom.contains("/")).otherwise(some)


def _header_map(arr: Column) -> Column:
    """F9 for every column: MAP name -> index of the first matching cell, only entries found."""
    entries = F.array(*[F.struct(F.lit(k).alias("k"), header_index(arr, kws).alias("v")) for k, kws in HEADER_COLUMNS])
    found = F.filter(entries, lambda e: e["v"].isNotNull())
    return F.when(F.size(found) >= 3, F.map_from_entries(found))


def _with_header_map(cells: DataFrame) -> DataFrame:
    """The header map that applies to each row of a header-layout document (NULL: none, or the row is no
    result row): that of its table's first header row for the rows below it, else the last one before the table."""
    head = F.when(F.col("layout") == "header", _header_map(F.col("cells")))
    c = cells.withColumn("_hm", head)
    table = Window.partitionBy("source_file", "page_no", "table_no")
    c = c.withColumn("_hrow", F.min(F.when(F.col("_hm").isNotNull(), F.col("row_no"))).over(table))
    first = F.when(F.col("row_no") == F.col("_hrow"), F.col("_hm"))
    upto = Window.partitionBy("source_file").orderBy("page_no", "table_no", "row_no").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_hrow").isNull() | (F.col("row_no") > F.col("_hrow"))
    return c.withColumn("_map", F.when(below, F.last(first, ignorenulls=True).over(upto))).drop("_hm", "_hrow")


def _shredded(cells: DataFrame, headers: DataFrame, pages: DataFrame | None = None, layout: str | None = None) -> DataFrame:
    """``(source_file, page_no, layout, r)``: the parsed rows of the sound documents (of one layout, or of all), those of
    page texts with ``layout`` ``text``."""
    sound = headers.where(F.col("error").isNull() & F.col("layout").isNotNull()).select("source_file", "layout")
    if layout:
        sound = sound.where(F.col("layout") == layout)
    c = cells.join(sound, "source_file").select("source_file", "page_no", "table_no", "row_no", "cells", "layout", F.lit(None).cast("string").alias("text"))
    if pages is not None:
        p = pages.join(sound.where(F.col("layout") == "header"), "source_file")
        empty = [F.lit(None).cast(c.schema[x].dataType).alias(x) for x in ("table_no", "row_no", "cells")]
        c = c.unionByName(p.select("source_file", "page_no", *empty, F.lit("text").alias("layout"), F.coalesce("text", F.lit("")).alias("text")))
    if layout in (None, "header"):
        c = _with_header_map(c.repartition("source_file"))              # the one exchange: every window below lies within a document
    arr, lay = F.col("cells"), F.col("layout")
    rows = {"left": left_row(arr), "right": right_row(arr), "score": score_row(arr)}
    if layout in (None, "header"):
        rows["header"] = F.when(F.col("_map").isNotNull(), header_row(arr, F.col("_map")))
    parsed = None
    for name, r in rows.items():
        if layout in (None, name):
            parsed = F.when(lay == name, r) if parsed is None else parsed.when(lay == name, r)
    c = c.select("source_file", "page_no", "layout", "text", parsed.alias("r"))
    if pages is None:
        return c.where(_named(lay, F.col("r"))).drop("text")
    both = c.withColumn("_on_page", F.count("r").over(Window.partitionBy("source_file", "page_no")))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.when(F.trim(x).rlike(r"^\d"), text_row(x))), lambda r: r.isNotNull())
    read = F.when((lay == "text") & (F.col("_on_page") == 0), lines).when(_named(lay, F.col("r")), F.array("r"))
    return both.select("source_file", "page_no", "layout", F.explode(read).alias("r"))


def _finish(rows: DataFrame, headers: DataFrame) -> DataFrame:
    h = headers.select("source_file", "NomCourse", "Date", "Distance")
    return rows.select("source_file", "page_no", "r.*").join(h, "source_file").select(*OUT_COLUMNS, "page_no")


def parse_left(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """V2."""
    return _finish(_shredded(cells, headers, layout="left"), headers).drop("page_no")


def parse_right(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """V3."""
    return _finish(_shredded(cells, headers, layout="right"), headers).drop("page_no")


def parse_score(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """V4."""
    return _finish(_shredded(cells, headers, layout="score"), headers).drop("page_no")


def parse_header(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """V5 + W15: header located by keywords; headerless tables reuse the last map of the document."""
    return _finish(_shredded(cells, headers, layout="header"), headers)


def parse_text_lines(cells: DataFrame, pages: DataFrame, headers: DataFrame) -> DataFrame:
    """V6: pages of header-layout documents without any parsed table row, read line by line."""
    rows = _shredded(cells, headers, pages, layout="header").where(F.col("layout") == "text")
    return _finish(rows, headers).drop("page_no")


def shred(cells: DataFrame, pages: DataFrame) -> dict[str, DataFrame]:
    """All layouts -> raw_results rows (+ source_file, racekey) in one pass over cells and pages, and the headers."""
    headers = cut_lineage(file_headers(pages))       # one row per document
    rows = _finish(_shredded(cells, headers, pages), headers).drop("page_no")
    return {"rows": rows.withColumn("racekey", race_key("NomCourse", "Date", "Distance")), "headers": headers}


def reconcile(rows: DataFrame, headers: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """Per file OK / MISMATCH (parsed != expected when known) / FAILED (0 rows, with the reason),
    and SKIPPED (0 rows) for the files of ``skipped(source_file)``, whose output already exists."""
    counts = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("parsed"))
    j = headers.join(counts, "source_file", "full_outer").withColumn("parsed", F.coalesce("parsed", F.lit(0)))
    status = (F.when(F.col("error").isNotNull(), "FAILED")
               .when(F.col("expected").isNotNull() & (F.col("parsed") != F.col("expected")), "MISMATCH")
               .otherwise("OK"))
    n = F.when(F.col("error").isNull(), F.col("parsed")).otherwise(0).cast("long")
    out = j.select(F.col("source_file").alias("file"), status.alias("status"), n.alias("rows"), n.alias("parsed"), "expected", "error")
    if skipped is None:
        return out
    zero = F.lit(0).cast("long")
    return out.unionByName(skipped.select(F.col("source_file").alias("file"), F.lit("SKIPPED").alias("status"), zero.alias("rows"),
                                          zero.alias("parsed"), F.lit(None).cast("int").alias("expected"), F.lit(None).cast("string").alias("error")))


def parse_report(report: DataFrame) -> DataFrame:
    """Files per status and total parsed rows."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("files"),
                                        F.coalesce(F.sum("parsed"), F.lit(0)).cast("long").alias("rows"))
