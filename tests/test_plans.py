"""Plan tests: no Python in the feature job, no Cartesian products, filters pushed to the scan."""

import random

import pytest

from pacekit.operators import resolve as RV
from pacekit.plans import queries_resolve as QR
from pacekit.plans.features import build_features
from pacekit.plans import scoring as S, reports as R
from pacekit.sources import adapters
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_job_stays_in_the_jvm(spark):
    p = plan(build_features(adapters.results(spark, SF_SMALL)))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_runner_windows_share_one_window_spec(spark):
    from pacekit.operators.history import add_history_windows, add_group_zscore
    r = adapters.results(spark, SF_SMALL, with_positions=False)
    p = add_history_windows(add_group_zscore(r, median=False))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Window [") <= 2  # one ordered spec (+ whole-partition min on the same spec)


def test_no_cartesian_in_matching_and_asof(spark):
    rows = adapters.names(spark, SF_SMALL)
    res = RV.resolve_names(rows)
    for df in (res["pairs"], res["matches"]):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    fact = adapters.results(spark, SF_SMALL, with_positions=False)
    races = adapters.dim_race(spark, SF_SMALL)
    probes = fact.select("runner_id", (fact["race_id"] + 1).alias("race_id"))
    p = plan(S.asof_features(fact, races, probes))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.fixture(scope="module")
def few_parts(spark, tmp_path_factory):
    """A folder with a table of parts with short, long and absent names, whose file looks small to Spark."""
    rng, folder = random.Random(8), str(tmp_path_factory.mktemp("parts"))
    names = [None, "cold gear", "cold gearx", "cold geary", "old gear", "a red plate of iron and copper", "a red plate of iron or copper"]
    rows = [(i, rng.choice(names), rng.choice(["SMALL", "LARGE", None]), i % 9) for i in range(900)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    return folder


def cut_plans(monkeypatch, *modules):
    """Gets the plans of all that these modules cut off."""
    plans = []
    for m in modules:
        cut = m.cut_lineage
        monkeypatch.setattr(m, "cut_lineage", lambda df, cut=cut: plans.append(plan(df)) or cut(df))
    return plans


def test_name_pairs_are_never_collected_on_the_driver(spark, monkeypatch, few_parts):
    plans = cut_plans(monkeypatch, RV)
    df = QR.token_sort_ratio(spark, few_parts)
    assert [p for p in [*plans, plan(df)] if "Join" in p]
    assert not [p for p in [*plans, plan(df)] if "BroadcastHashJoin" in p]
    got = [(r.name_1, r.name_2) for r in df.collect()]
    assert len(got) == len(set(got)) > 20 and all(a < b for a, b in got)


def test_matching_passes_are_never_collected_on_the_driver(spark, monkeypatch, few_parts):
    plans = cut_plans(monkeypatch, RV)
    df = QR.frequent_pairs(spark, few_parts)
    assert len([p for p in plans if "Join" in p]) >= 4 and not [p for p in plans if "BroadcastHashJoin" in p]
    got = {r.name_1: r for r in df.collect()}
    assert got and all(r.name_1 < r.name_2 and r.canonical in (r.name_1, r.name_2) and r.final_score >= 95 for r in got.values())


def test_corrected_names_keep_every_row_without_the_driver(spark, monkeypatch, few_parts):
    monkeypatch.setattr(QR, "_RESOLVED", {})
    plans = cut_plans(monkeypatch, RV)
    df = QR.corrected_names(spark, few_parts)
    assert not [p for p in [*plans, plan(df)] if "BroadcastHashJoin" in p]
    got, pairs = df.collect(), QR.frequent_pairs(spark, few_parts).collect()
    assert sorted(r.row_id for r in got) == list(range(900))
    assert pairs and not {r.Nom_clean for r in got} & {p.other for p in pairs} - {p.canonical for p in pairs}


def test_name_report_counts_the_corrected_rows_without_the_driver(spark, monkeypatch, few_parts):
    monkeypatch.setattr(QR, "_RESOLVED", {})
    plans = cut_plans(monkeypatch, RV)
    df = QR.name_report(spark, few_parts)
    assert not [p for p in [*plans, plan(df)] if "BroadcastHashJoin" in p]
    rows, report = QR.corrected_names(spark, few_parts).collect(), df.first()
    chosen = [r for r in QR.rare_matches(spark, few_parts).collect() if r.chosen]
    assert report.corrections == len({p.other for p in QR.frequent_pairs(spark, few_parts).collect()}) + len(chosen) > 0
    assert report.unique_before == len({r.Nom for r in rows} - {None}) > report.unique_after == len({r.Nom_clean for r in rows})


def test_few_strings_with_many_rests_are_dealt_into_parts(spark, monkeypatch):
    dealt, pairs = [], RV._short_pairs
    monkeypatch.setattr(RV, "_short_pairs", lambda left, *a: dealt.append(left) or pairs(left, *a))
    keys = spark.range(12_000).selectExpr("concat('runner ', id) AS k", "'H' AS s").coalesce(1)
    RV.similar_pairs(keys, keys, "k", ["s"])
    assert dealt[0].rdd.getNumPartitions() == 3


def test_filters_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from pacekit.sources.tables import table
    df = table(spark, SF_SMALL, "orders").where(F.col("o_totalprice") > 1000).select("o_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p


def test_missing_table_gives_typed_nulls(spark, tmp_path):
    from pacekit.plans import reports as R
    fact = adapters.results(spark, SF_SMALL, with_positions=False)
    pred = R.predictions_or_nulls(spark, str(tmp_path))
    assert pred is None
    out = R.with_expected(fact.select("runner_id", "race_id"), pred)
    assert dict(out.dtypes)["predicted_z"] == "double" and out.where("predicted_z IS NOT NULL").count() == 0


def test_user_filters(spark):
    from pacekit.plans import reports as R
    fact = adapters.results(spark, SF_SMALL, with_positions=False)
    assert R.user_filters(fact).count() == fact.count()
    assert R.user_filters(fact, category="Toutes").count() == fact.count()
    y = fact.agg({"year": "max"}).first()[0]
    assert R.user_filters(fact, years=[y]).where(f"year <> {y}").count() == 0
    assert R.user_filters(fact, category="1-URGENT").where("category <> '1-URGENT'").count() == 0
