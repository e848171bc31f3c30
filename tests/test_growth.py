"""Steps whose cost must not outgrow the rows: joins that collect no growing table, one exchange a runner, one sort for two ranks."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pacekit.operators import prefix as PX, ranking as RK
from pacekit.operators.state import extend_history
from pacekit.plans import scoring as S
from pacekit.sources import adapters, documents, warehouse as WH
from conftest import SF_SMALL
from test_plans import plan
from test_state import SCHEMA, flat, rows


def test_people_are_not_collected(spark):
    for df in (documents.result_fields(spark, SF_SMALL), adapters._raw_results(spark, SF_SMALL)):
        assert "Broadcast" not in plan(df)


def test_two_ranks_from_one_sort(spark, monkeypatch):
    rnd = random.Random(5)
    data = [(rnd.choice([0, 0, 0, 1, 2, None]), rnd.choice(["a", "b", None]), rnd.randint(0, 9), i) for i in range(500)]
    df = spark.createDataFrame(data, "g int, c string, v int, id int").repartition(5)
    cuts, cut = [], RK.cut_to_files
    monkeypatch.setattr(RK, "cut_to_files", lambda x: cuts.append(1) or cut(x))
    got = RK.group_row_number(df, ["g"], ["v", "id"], "rn", within={"rc": ["c"]})
    want = df.select("*", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).alias("rn"),
                     F.row_number().over(Window.partitionBy("g", "c").orderBy("v", "id")).alias("rc"))
    assert got.columns == want.columns and len(cuts) == 1
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)


@pytest.mark.parametrize("hot_rows", [20, 10 ** 6])
def test_history_of_hot_and_ordinary_runners(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(PX, "HOT_ROWS", hot_rows)
    df, segmented, seen = spark.createDataFrame(rows(), SCHEMA), PX.add_history_segmented, []
    want = flat(segmented(df))
    monkeypatch.setattr(PX, "add_history_segmented", lambda x, *a, **k: seen.append(1) or segmented(x, *a, **k))
    assert flat(PX.add_history_split(df)) == want and len(seen) == (hot_rows == 20)
    first, state = extend_history(df.where("result_id < 300"), None)
    then, _ = extend_history(df.where("result_id >= 300"), state)
    assert sorted(flat(first) + flat(then), key=lambda r: str(r[0])) == want


def asof_inputs(spark):
    rng = random.Random(8)
    results = [(i, rng.choice([1, 1, 1, 2, 3, None]), i % 12, dt.date(2001, 1 + i % 12, 1), 9 + rng.random()) for i in range(240)]
    results = spark.createDataFrame(results, "result_id long, runner_id long, race_id int, date date, speed_kmh double")
    probes = spark.createDataFrame([(r, k, dt.date(2001, 1 + k, 1), 5.0 + k) for r in (1, 2, 4) for k in range(12)],
                                   "runner_id long, race_id int, date date, distance double")
    return results, probes


def test_asof_of_hot_and_ordinary_runners(spark):
    results, probes = asof_inputs(spark)
    races = probes.select("race_id", "date", "distance").distinct()
    key = lambda df: [[round(v, 9) if isinstance(v, float) else v for v in r] for r in df.orderBy("runner_id", "race_id").collect()]
    want = key(S.asof_features(results, races, probes, segmented=False))
    for hot_rows in (100, 10 ** 6):
        assert key(S._asof(results, probes, hot_rows=hot_rows)) == want
    assert len(want) == 36


def test_whatif_runs_the_windows_once_and_keeps_repeats(spark):
    results, probes = asof_inputs(spark)
    races = probes.select("race_id", "date", "distance").distinct()
    asked = spark.createDataFrame([(1, 3), (4, 5), (4, 5), (2, 99), (None, 3), (1, None)], "runner_id long, race_id int")

    class Model:
        transform = staticmethod(lambda df: df.withColumn("predicted_z", F.lit(0.5)))
    out = S.whatif(results, races, asked, Model)
    assert plan(out).count("last(state") == 1
    got = sorted((str(r.runner_id), str(r.race_id), r.status, r.predicted_z, r.predicted_speed_kmh) for r in out.collect())
    assert got == sorted([("1", "3", "already_run", None, None), *[("4", "5", "not_enough_history", None, None)] * 2, ("2", "99", "race_not_found", None, None),
                          ("None", "3", "race_not_found", None, None), ("1", "None", "race_not_found", None, None)])


def test_years_do_not_bound_the_tasks_of_a_load(spark):
    df = spark.range(10).withColumn("year", F.lit(2000))
    assert "REBALANCE" in plan(WH.by_partition(df, "year")) and WH.by_partition(df, "year").count() == 10
