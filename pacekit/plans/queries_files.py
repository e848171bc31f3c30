"""Registered queries on files, stored tables and small reads."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import adapters, documents as D, files as FL, warehouse as WH
from . import model as M
from . import profiling as PR
from . import reports as R
from .catalog import register
from .features import build_features
from .oracle import RESULTS_CTE, with_ctes
from .oracle_model import model_sql
from .queries_model import _coarse, _coarse_sql, _features, _trained
from .queries_reports import _BY_RACE
from .queries_shred import _TEXT, DOC_CTE
from ..operators import shred as SH


def _folder(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("document_files", with_ctes("""
SELECT source_file, octet_length(encode(any_value(top) || chr(10) || string_agg(concat_ws(' ', position, rid, first_part, last_part, sexe,
         club, cat, position_category, temps), chr(10) ORDER BY position))) + 1 AS length
FROM rl JOIN tops USING (source_file) GROUP BY source_file""", RESULTS_CTE, DOC_CTE, _TEXT))
def document_files(spark, sf):
    """S3: the documents' texts as files, one a document, and their listing with sizes."""
    folder = _folder(spark, "documents")
    texts = SH.document_text(D.page_text(spark, sf)).select(F.col("full_text").alias("value"), "source_file")
    texts.write.partitionBy("source_file").text(folder)
    found = FL.list_documents(spark, folder, "*.txt")
    return found.select(F.regexp_extract("path", "source_file=([^/]+)/", 1).alias("source_file"), "length")


@register("consolidated_cells", with_ctes("""
SELECT source_file, count(*) FILTER (WHERE NOT (season = 2025 AND (race_id // 20) % 2 = 0 AND page_no % 2 = 0)) + 1 AS n_rows,
       race_id % 2 = 0 AS second_wave
FROM rl GROUP BY source_file, race_id""", RESULTS_CTE, DOC_CTE))
def consolidated_cells(spark, sf):
    """S5 + S6: documents written in two waves, the second without those already done; the folder
    read as one table."""
    folder, cells = _folder(spark, "cells"), D.cells(spark, sf)
    odd = F.regexp_extract("source_file", r"-race-(\d+)\.pdf$", 1).cast("int") % 2 == 1
    cells.where(odd).withColumn("second_wave", F.lit(False)).write.parquet(os.path.join(folder, "wave=1"))
    done = spark.read.parquet(os.path.join(folder, "wave=1")).select("source_file").distinct()
    FL.not_yet_done(cells, done).withColumn("second_wave", F.lit(True)).write.parquet(os.path.join(folder, "wave=2"))
    return FL.consolidate(spark, folder).groupBy("source_file", "second_wave").agg(F.count(F.lit(1)).alias("n_rows"))


@register("races_of_given_year", with_ctes("""
SELECT race_id, name, date, distance, n AS participants, v / n AS avg_speed, p / n AS avg_pace_sec_km FROM by_race WHERE year = 1997""",
                                           RESULTS_CTE, _BY_RACE), doubles=("distance", "avg_speed", "avg_pace_sec_km"))
def races_of_given_year(spark, sf):
    """The parameterised form."""
    return R.races_of_year(adapters.results(spark, sf, with_positions=False), adapters.dim_race(spark, sf), 1997)


@register("expected_or_nulls", _coarse_sql(model_sql("""
SELECT 'absent' AS analysis, result_id, NULL::DOUBLE AS predicted_z, NULL::DOUBLE AS predicted_time_sec FROM results
UNION ALL SELECT 'stored', r.result_id, pr.predicted_z, pr.predicted_time_sec
FROM results r LEFT JOIN pred pr ON r.runner_id = pr.runner_id AND r.race_id = pr.race_id""", RESULTS_CTE),
                                          "predicted_z", "predicted_time_sec"))
def expected_or_nulls(spark, sf):
    """Results with stored predictions, or typed NULLs while the analysis table is absent."""
    fact, cols = adapters.results(spark, sf, with_positions=False), ("predicted_z", "predicted_time_sec")
    root = WH.new_warehouse(spark)
    absent = R.with_expected(fact, R.predictions_or_nulls(spark, root, cols=cols), cols=cols)
    WH.load_analysis(spark, root, _features(spark, sf))
    WH.write_back_predictions(spark, root, _trained(spark, sf)["predictions"])
    stored = R.with_expected(fact, R.predictions_or_nulls(spark, root, cols=cols), cols=cols)
    out = [df.select(F.lit(k).alias("analysis"), "result_id", *cols) for k, df in (("absent", absent), ("stored", stored))]
    return _coarse(out[0].unionByName(out[1]))


@register("replaced_table", with_ctes("""
SELECT race_id, racekey, year, 2 AS version FROM dim_race""", RESULTS_CTE))
def replaced_table(spark, sf):
    """A table replaced by rows read from itself; readers see the second version only."""
    root, races = WH.new_warehouse(spark), adapters.dim_race(spark, sf).select("race_id", "racekey", "year")
    WH.replace_table(spark, root, "races", races.withColumn("version", F.lit(1)))
    WH.replace_table(spark, root, "races", WH.read_table(spark, root, "races").withColumn("version", F.col("version") + 1))
    return WH.read_table(spark, root, "races")


@register("artifact_scoring", _coarse_sql(model_sql("SELECT source_result_id, predicted_z, split FROM pred"), "predicted_z"))
def artifact_scoring(spark, sf):
    """The model saved, loaded again and applied to the prepared rows."""
    path = _folder(spark, "artifact")
    M.save_artifact(_trained(spark, sf), path)
    loaded = M.load_artifact(path)
    data = M.temporal_split(M.prepare_dataset(build_features(adapters.results(spark, sf))))
    return _coarse(loaded["model"].transform(data.where("split IS NOT NULL")).select("source_result_id", "predicted_z", "split"))


_P18 = """
SELECT {n} AS filters, count(*) AS n, count(DISTINCT f.race_id) AS races, min(f.time_sec) AS fastest FROM results f WHERE {w}"""


@register("filtered_results", with_ctes(" UNION ALL ".join(
    _P18.format(n=f"'{n}'", w=w) for n, w in (("none", "true"), ("years", "f.year IN (1996, 1998)"), ("category", "f.category = '1-URGENT'"),
                                              ("both", "f.year IN (1996, 1998) AND f.category = '1-URGENT'"))), RESULTS_CTE))
def filtered_results(spark, sf):
    """Optional predicates on years and category."""
    fact, out = adapters.results(spark, sf, with_positions=False), None
    for name, years, category in (("none", None, "Toutes"), ("years", [1996, 1998], None), ("category", [], "1-URGENT"),
                                  ("both", [1996, 1998], "1-URGENT")):
        one = R.user_filters(fact, years, category).agg(F.lit(name).alias("filters"), F.count(F.lit(1)).alias("n"),
                                                        F.countDistinct("race_id").alias("races"), F.min("time_sec").alias("fastest"))
        out = one if out is None else out.unionByName(one)
    return out


@register("sorted_categories", with_ctes("""
SELECT row_number() OVER (ORDER BY category) AS rank, category FROM (SELECT DISTINCT category FROM results)""", RESULTS_CTE))
def sorted_categories(spark, sf):
    """Distinct values in order."""
    return PR.sorted_distinct(adapters.results(spark, sf, with_positions=False), "category")


@register("existence_probe", with_ctes("""
SELECT coalesce(bool_or(time_sec > 7200), false) AS slow, coalesce(bool_or(distance < 1), false) AS short,
       coalesce(bool_or(category IS NULL), false) AS no_category, count(*) > 0 AS some FROM results""", RESULTS_CTE))
def existence_probe(spark, sf):
    """O6."""
    return PR.existence(adapters.results(spark, sf, with_positions=False), slow=F.col("time_sec") > 7200, short=F.col("distance") < 1,
                        no_category=F.col("category").isNull(), some=F.lit(True))


@register("first_rows", with_ctes("""
SELECT result_id, runner_id, race_id, time_sec FROM results ORDER BY date, result_id LIMIT 5""", RESULTS_CTE))
def first_rows(spark, sf):
    """A28."""
    fact = adapters.results(spark, sf, with_positions=False)
    return PR.first_rows(fact, ["date", "result_id"]).select("result_id", "runner_id", "race_id", "time_sec")
