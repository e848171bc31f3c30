"""Warehouse idempotence, golden cell rows (F-A), zip expansion, incremental ingest."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from pacekit.operators import shred as SH
from pacekit.plans.profiling import with_derived
from pacekit.plans.queries_cleaning import cleaned
from pacekit.sources import documents as D
from pacekit.sources import files as FL
from pacekit.sources import warehouse as WH
from pacekit.streaming import ingest as ST
from conftest import SF_SMALL


def test_dimension_load_is_idempotent(spark):
    root = WH.new_warehouse(spark)
    clean = with_derived(cleaned(spark, SF_SMALL)).drop("temps_clean")
    a = WH.load_star(spark, root, clean)
    n = (a["dim_runner"].count(), a["dim_race"].count(), a["fact_results"].count())
    b = WH.load_star(spark, root, clean)
    assert (b["dim_runner"].count(), b["dim_race"].count(), b["fact_results"].count()) == n
    assert a["fact_results"].select("result_id").distinct().count() == n[2]
    c = WH.load_star(spark, root, clean, dedup=False)   # reference mode: blind append duplicates facts
    assert c["fact_results"].count() == 2 * n[2]


def _headers(spark, layout):
    return spark.createDataFrame([("f.pdf", layout, "Course", None, 10.0, None, None)],
                                 "source_file string, layout string, NomCourse string, Date date, "
                                 "Distance double, expected int, error string")


def test_golden_cells_left(spark):
    rows = [(["1", "12", "dupont jean", "*", "SH", "1", "0:40:00"],),      # bib present
            (["2", "martin paul", "AC club", "V1", "1", "0:41:00"],),    # bib absent -> offset
            (["Pl.", "Dos", "Nom"],),                                   # header row
            (["3", "14", "0", "-", "SH", "2", "0:42:00"],),               # name '0' dropped
            (["4", "15", "x"],)]                                        # short row
    c = spark.createDataFrame([("f.pdf", 1, 1, i, r[0]) for i, r in enumerate(rows)],
                              "source_file string, page_no int, table_no int, row_no int, cells array<string>")
    out = SH.parse_left(c, _headers(spark, "left")).orderBy("Position").collect()
    assert [(r.Position, r.Nom, r.Club, r.Sexe) for r in out] == [("1", "Dupont Jean", "", "H"),
                                                                  ("2", "Martin Paul", "Ac Club", "H")]


def test_shredding_is_one_pass(spark):
    """All layouts, header carry and text fallback: cells and pages scanned once and dealt by document once."""
    import re
    cells, pages = D.cells(spark, SF_SMALL), D.page_text(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = SH.shred(cells, pages)
        plan = SH.reconcile(out["rows"], out["headers"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len([x for x in scans if "cells" in x]) == 1 and len([x for x in scans if "text" in x]) == 1
    assert not re.findall(r"Exchange hashpartitioning\([^)]*page_no", plan) and plan.count("REPARTITION_BY_COL") == 1


def test_header_carry(spark):
    """Rows above a table's header are none; a table without one takes the last map before it; a second header row changes nothing."""
    head, swapped = ["Rank", "Nom", "Sexe", "Club", "Cat", "Temps"], ["Nom", "Sexe", "Club", "Cat", "Temps", "Rank"]
    row = lambda i: [str(i), f"name {i}", "H", "ac", "SH", "00:40:00"]                             # noqa: E731
    tables = {(1, 1): [row(1), head, row(2), swapped, row(3)], (1, 2): [row(4)], (2, 1): [swapped, ["name x", "F", "", "SD", "00:41:00", "5"]], (2, 2): [["name y", "F", "", "SD", "00:42:00", "6"]]}
    cells = [("f.pdf", p, t, i, r) for (p, t), rows in tables.items() for i, r in enumerate(rows)]
    c = spark.createDataFrame(cells, "source_file string, page_no int, table_no int, row_no int, cells array<string>")
    got = {(r.Position, r.Nom, r.page_no) for r in SH.parse_header(c, _headers(spark, "header")).collect()}
    assert got == {("2", "Name 2", 1), ("3", "Name 3", 1), ("4", "Name 4", 1), ("5", "Name X", 2), ("6", "Name Y", 2)}


def test_malformed_headers_fail_their_files(spark):
    top = "RESULTATS\nCourse 1 {y}\nCourse 1 SEF : 3 DISTANCE : {d} km\n{w}\n"
    rows = [("ok.pdf", 1, top.format(y=2006, d="10,5", w="lundi 5 mai 2006")), ("distance.pdf", 1, top.format(y=2006, d="1.2.3", w="lundi 5 mai 2006")),
            ("day.pdf", 1, top.format(y=2007, d="10", w="lundi 32 mai 2007")), ("none.pdf", 1, "no ranking"), ("none.pdf", 2, None)]
    h = SH.file_headers(spark.createDataFrame(rows, "source_file string, page_no int, text string"))
    assert {r.source_file: r.error for r in h.collect()} == {"ok.pdf": None, "distance.pdf": "malformed distance", "day.pdf": "invalid date",
                                                             "none.pdf": "no parser found"}
    parsed = spark.createDataFrame([("ok.pdf",)] * 3, "source_file string")
    done = spark.createDataFrame([("old.pdf",)], "source_file string")
    report = {r.file: (r.status, r.rows) for r in SH.reconcile(parsed, h, done).collect()}
    assert report == {"ok.pdf": ("OK", 3), "distance.pdf": ("FAILED", 0), "day.pdf": ("FAILED", 0), "none.pdf": ("FAILED", 0), "old.pdf": ("SKIPPED", 0)}


def test_table_replacement(spark):
    """A table replaced by rows read from itself; a failing write changes nothing."""
    root = WH.new_warehouse(spark)
    assert not WH.table_exists(spark, root, "t") and WH.read_table(spark, root, "t") is None
    WH.replace_table(spark, root, "t", spark.range(5).toDF("a"))
    WH.replace_table(spark, root, "t", WH.read_table(spark, root, "t").where("a > 2").withColumn("b", F.lit("x")))
    assert sorted(map(tuple, WH.read_table(spark, root, "t").collect())) == [(3, "x"), (4, "x")]
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("a"))
    with pytest.raises(Exception):
        WH.replace_table(spark, root, "t", broken)
    assert WH.read_table(spark, root, "t").count() == 2
    WH.truncate_and_load(spark, root, "t", spark.range(3).select(F.col("id").alias("a"), F.lit(1).alias("unknown")))
    assert sorted(map(tuple, WH.read_table(spark, root, "t").collect())) == [(0, None), (1, None), (2, None)]
    WH.drop_warehouse(spark, root)
    assert not WH.table_exists(spark, root, "t")


def test_partitions_are_replaced_one_by_one(spark):
    root = WH.new_warehouse(spark)
    rows = lambda *r: spark.createDataFrame(r, "v int, year int")                                   # noqa: E731
    WH.write_table(rows((1, 2000), (2, 2001), (3, 2001)), root, "t", partition="year")
    files = set(WH.read_table(spark, root, "t").where("year = 2000").inputFiles())
    WH.truncate_and_load(spark, root, "t", rows((9, 2001), (8, 2002)), dynamic=True)
    table = WH.read_table(spark, root, "t")
    assert sorted(map(tuple, table.collect())) == [(1, 2000), (8, 2002), (9, 2001)]
    assert set(table.where("year = 2000").inputFiles()) == files
    for epoch in (0, 1, 1):                                                                       # the second run of 1 replaces it
        WH.write_epoch(spark, root, "r", rows((epoch, 5)), epoch)
    assert sorted(r.v for r in WH.read_table(spark, root, "r").collect()) == [0, 1]


def test_a_stored_table_evolves(spark):
    """Columns added to the stored table; old rows are NULL there, also by its files alone."""
    root = WH.new_warehouse(spark)
    WH.write_table(spark.createDataFrame([(1, 2000)], "a int, year int"), root, "t", partition="year")
    for _ in range(2):                                                                            # idempotent
        table = WH.add_columns(spark, root, "t", {"a": "int", "B": "double", "c": "string"})
    assert table.columns == ["a", "B", "c", "year"]
    WH.append_rows(spark, root, "t", spark.createDataFrame([("x", 2, 2000, 7)], "c string, a int, year int, other int"))
    WH.append_rows(spark, root, "t", spark.createDataFrame([(0.5, 3, 2001)], "B double, a int, year int"))
    want = [(1, None, None, 2000), (2, None, "x", 2000), (3, 0.5, None, 2001)]
    assert sorted(map(tuple, WH.read_table(spark, root, "t").collect())) == want
    folder = WH.read_table(spark, root, "t").inputFiles()[0].split("/year=")[0]
    merged = spark.read.option("mergeSchema", True).parquet(folder).select("a", "B", "c", "year")
    assert sorted(map(tuple, merged.collect())) == want


def test_predictions_of_some_years_leave_the_others(spark):
    root = WH.new_warehouse(spark)
    rows = spark.createDataFrame([(i, 2000 + i % 3) for i in range(12)], "source_result_id long, year int")
    WH.load_analysis(spark, root, rows)
    p = lambda z, ids: spark.createDataFrame([(i, z, z, z, z, z, "test") for i in ids], "source_result_id long, predicted_z double, predicted_performance_index double, predicted_speed_kmh double, predicted_time_sec double, abs_error_time_sec double, split string")  # noqa: E731,E501
    assert WH.write_back_predictions(spark, root, p(1.0, range(12)))[1] == 12
    table, n = WH.write_back_predictions(spark, root, p(2.0, [1, 2, 4]), years=[2001])
    got = {r.source_result_id: r.predicted_z for r in table.collect()}
    assert n == 10 and got == {i: (2.0 if i in (1, 4) else None) if i % 3 == 1 else 1.0 for i in range(12)}


def test_stored_reports_prune_and_do_not_exchange(spark):
    """The year's partition by a pruning subquery; the runners' windows on the buckets as they are."""
    from pacekit.plans import star
    from pacekit.plans.queries_warehouse import _loaded
    root = _loaded(spark, SF_SMALL)["root"]
    with_plan = lambda df: df._jdf.queryExecution().executedPlan().toString()                     # noqa: E731
    chosen = star.dim_race(spark, root).where(F.col("name") == "Course 7").select("race_id", "year", "name")
    plan = with_plan(star.facts(spark, root, chosen).groupBy("race_id").count())
    assert "dynamicpruning" in plan.lower()
    history = with_plan(star.runner_history(spark, root))
    assert "Window" in history and "Exchange" not in history
    shown = {"spark.sql.maxMetadataStringLength": "10000", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    for k, v in shown.items():
        spark.conf.set(k, v)
    one = with_plan(star.facts(spark, root).where("runner_id = 3"))
    for k in shown:
        spark.conf.unset(k)
    assert "SelectedBucketsCount: 1 out of 8" in one


def test_golden_cells_right(spark):
    rows = [["1", "12", "DUPONT", "Jean", "RC Huy", "SH", "1", "0:40:00", "4:00", "15.0"],
            ["2", "MARTIN", "Paul", "SE", "SE", "1", "0:41:00", "4:06", "14.6"],   # category as last middle cell
            ["3", "13", "LEROY Anne", "SD", "1", "0:50:00", "5:00", "12.0"]]
    c = spark.createDataFrame([("f.pdf", 1, 1, i, r) for i, r in enumerate(rows)],
                              "source_file string, page_no int, table_no int, row_no int, cells array<string>")
    out = {r.Position: (r.Nom, r.Club, r.Categorie) for r in SH.parse_right(c, _headers(spark, "right")).collect()}
    assert out == {"1": ("Dupont Jean", "Rc Huy", "SH"), "2": ("Martin Paul Se", None, "SE"),
                   "3": ("Leroy Anne", None, "SD")}


def test_zip_expansion(spark, tmp_path):
    d = tmp_path / "in" / "sub"
    d.mkdir(parents=True)
    for name, members in [("a.zip", {"x/r1.pdf": b"1", "r2.pdf": b"22"}), ("b.zip", {"r1.pdf": b"333"})]:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            for m, data in members.items():
                zf.writestr(m, data)
        (d / name).write_bytes(buf.getvalue())
    (d / "bad.zip").write_bytes(b"not a zip")
    m = FL.expand_archives(spark, str(tmp_path / "in"))
    st = {(r.name, r.status) for r in m.collect()}
    assert ("r1.pdf", "EXTRACTED") in st and ("r1.pdf", "SKIPPED") in st and ("r2.pdf", "EXTRACTED") in st
    assert (None, "FAILED") in st
    rep = FL.extraction_report(m).first()
    assert (rep.extracted, rep.skipped, rep.failed, rep.total_bytes) == (2, 1, 1, 3)


def _landing(spark, base, n=6):
    cells, pages = D.cells(spark, SF_SMALL), D.page_text(spark, SF_SMALL)
    files = [r[0] for r in cells.select("source_file").distinct().orderBy("source_file").limit(n).collect()]
    cdir, pdir, ck = (os.path.join(base, x) for x in ("c", "p", "ck"))

    def drop(names, landed):
        ST.drop_documents(cells, pages, cdir, pdir, spark.createDataFrame([(f,) for f in names], "source_file string"), landed)
    return files, drop, (cdir, pdir, WH.new_warehouse(spark), ck)


def _star(spark, root):
    """The facts by natural keys, and the dimensions' ids."""
    facts, runners, races = (WH.read_table(spark, root, t) for t in (WH.FACT, WH.DIM_RUNNER, WH.DIM_RACE))
    flat = facts.join(runners.drop("epoch"), "runner_id").join(races.select("race_id", "racekey"), "race_id")
    rows = sorted(map(tuple, flat.select("racekey", "name_clean", "source_file", "time_sec").collect()), key=str)
    return rows, {r.name_clean: r.runner_id for r in runners.collect()}, facts.count(), runners.count(), races.count()


def test_incremental_ingest_processes_each_document_once(spark, tmp_path):
    files, drop, at = _landing(spark, str(tmp_path))
    drop(files[:3], "one")
    ST.run_ingest(spark, *at)
    _, ids, n1, _, _ = _star(spark, at[2])
    drop(files[3:], "two")
    drop(files[:1], "three")                                      # delivered again: left out
    ST.run_ingest(spark, *at)
    ST.run_ingest(spark, *at)                                     # nothing new
    rows, again, n2, runners, races = _star(spark, at[2])
    assert n2 > n1 and len(rows) == n2 and len(set(rows)) == n2
    assert len(set(again.values())) == runners == len(again) and {k: again[k] for k in ids} == ids
    facts = WH.read_table(spark, at[2], WH.FACT)
    assert facts.select("result_id").distinct().count() == n2
    rep = WH.read_table(spark, at[2], "parse_report")
    assert {r.file for r in rep.collect()} == set(files)
    # the same documents at once give the same star schema
    files, drop, other = _landing(spark, str(tmp_path / "whole"))
    drop(files, "all")
    ST.run_ingest(spark, *other)
    assert _star(spark, other[2])[0] == rows


def test_a_failed_batch_is_replayed(spark, tmp_path, monkeypatch):
    """The sink fails after the dimensions are written: the next run writes the batch again, with the same ids."""
    files, drop, at = _landing(spark, str(tmp_path), 4)
    drop(files[:2], "one")
    ST.run_ingest(spark, *at)
    drop(files[2:], "two")
    whole, calls = WH.write_epoch, []

    def failing(spark_, root, name, df, epoch):
        out = whole(spark_, root, name, df, epoch)
        if name == WH.DIM_RACE:
            calls.append({r.name_clean: r.runner_id for r in WH.read_table(spark_, root, WH.DIM_RUNNER).collect()})
            raise RuntimeError("lost")
        return out
    monkeypatch.setattr(WH, "write_epoch", failing)
    with pytest.raises(Exception):
        ST.run_ingest(spark, *at)
    monkeypatch.setattr(WH, "write_epoch", whole)
    ST.run_ingest(spark, *at)
    rows, ids, n, runners, _ = _star(spark, at[2])
    assert calls == [ids] and len(rows) == n == len(set(rows)) and runners == len(ids)
    files, drop, other = _landing(spark, str(tmp_path / "whole"), 4)
    drop(files, "all")
    ST.run_ingest(spark, *other)
    assert _star(spark, other[2])[0] == rows


def test_a_batch_reads_its_own_landing(spark, tmp_path, monkeypatch):
    """Earlier landings' pages and the dimensions are not read again."""
    files, drop, at = _landing(spark, str(tmp_path), 4)
    drop(files[:2], "one")
    ST.run_ingest(spark, *at)
    drop(files[2:], "two")
    seen, shred = [], SH.shred
    monkeypatch.setattr(SH, "shred", lambda cells, pages: seen.extend(r[0] for r in pages.select(F.input_file_name()).distinct().collect()) or shred(cells, pages))
    monkeypatch.setattr(WH, "read_table", lambda *a: pytest.fail("a stored table is read back"))
    ST.run_ingest(spark, *at)
    assert seen and all("landed=two" in f for f in seen)
