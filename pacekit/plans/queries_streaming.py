"""Registered streaming query (ST1): the documents adapter delivered in two waves."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import documents as D
from ..sources import warehouse as WH
from ..streaming import ingest as ST
from .catalog import register
from .oracle import RESULTS_CTE, with_ctes
from .queries_shred import DOC_CTE

# Oracle: after both waves (and the no-op re-run) every parsed, deduplicated row is one fact.
_SQL = with_ctes("""
SELECT lower(trim("NomCourse")) || '_' || strftime("Date", '%Y-%m-%d') || '_' || CAST("Distance" AS VARCHAR) AS racekey,
       count(DISTINCT "Nom") AS facts
FROM expected GROUP BY 1""", RESULTS_CTE, DOC_CTE)


@register("incremental_ingest", _SQL)
def incremental_ingest(spark, sf):
    """Odd races arrive first, even races later; each run ingests only the new documents.
    Returns facts per race after both runs (no duplicates from the re-run)."""
    base = scratch_path(spark, f"ingest-{uuid.uuid4().hex[:12]}")
    cells_dir, pages_dir = os.path.join(base, "cells"), os.path.join(base, "pages")
    root, ckpt = WH.new_warehouse(spark), os.path.join(base, "checkpoint")
    cells, pages = D.cells(spark, sf), D.page_text(spark, sf)
    files = cells.select("source_file").distinct().withColumn(
        "_wave", F.regexp_extract("source_file", r"-race-(\d+)\.pdf$", 1).cast("int") % 2)
    for wave in (1, 0):
        ST.drop_documents(cells, pages, cells_dir, pages_dir, files.where(F.col("_wave") == wave).select("source_file"), f"wave{wave}")
        ST.run_ingest(spark, cells_dir, pages_dir, root, ckpt)
    ST.run_ingest(spark, cells_dir, pages_dir, root, ckpt)   # nothing new: must be a no-op
    facts, races = WH.read_table(spark, root, WH.FACT), WH.read_table(spark, root, WH.DIM_RACE)
    return facts.join(races, "race_id").groupBy("racekey").agg(F.count(F.lit(1)).alias("facts"))
