"""OLS against NumPy normal equations; metrics definitions; artifact round trip."""

import numpy as np
from pyspark.sql import functions as F

from pacekit.plans import model as M
from pacekit.plans.features import build_features
from pacekit.sources import adapters
from conftest import SF_MID


def test_ols_matches_numpy(spark, tmp_path):
    feats = build_features(adapters.results(spark, SF_MID))
    res = M.train(feats)
    data = M.temporal_split(M.prepare_dataset(feats))
    tr = data.where(F.col("split") == "train").toPandas()
    X = tr[M.FEATURE_COLUMNS].astype(float)
    X = X.fillna({c: res["medians"][c] for c in M.FEATURE_COLUMNS})
    Xs = (X - X.mean()) / X.std(ddof=0).replace(0, 1)
    A = np.column_stack([np.ones(len(Xs)), Xs.values])
    beta, *_ = np.linalg.lstsq(A, tr["target_z"].values, rcond=None)
    pred = res["predictions"].where(F.col("split") == "train").select("source_result_id", "predicted_z").toPandas()
    want = dict(zip(tr["source_result_id"], A @ beta))
    for k, v in zip(pred["source_result_id"], pred["predicted_z"]):
        assert abs(want[k] - v) < 1e-6
    n = len(tr)
    coefs = {r.feature: r.coefficient for r in M.coefficients(res["model"], n_train=n).collect()}
    for f, b in zip(M.FEATURE_COLUMNS, beta[1:]):
        if f in coefs:
            assert abs(coefs[f] - b) < 1e-6
    m = {r.split: r for r in res["metrics"].collect()}
    assert m["train"].n == n and 0 <= m["train"].r2_z <= 1
    path = str(tmp_path / "artifact")
    M.save_artifact(res, path)
    loaded = M.load_artifact(path)
    assert loaded["ok"] and loaded["features"] == M.FEATURE_COLUMNS
    assert not M.load_artifact(str(tmp_path / "missing"))["ok"]


def test_moments_equal_spark_ml(spark):
    """The fit from additive statistics is that of Spark ML's pipeline; years merge in any way."""
    data = M.temporal_split(M.prepare_dataset(build_features(adapters.results(spark, SF_MID)))).cache()
    tr = data.where(F.col("split") == "train")
    medians = M.exact_medians(tr, M.FEATURE_COLUMNS)
    rows = M.moments(tr, medians).collect()
    fit = M.solve(rows, medians)
    ml = M.build_pipeline(medians).fit(tr)
    assert np.allclose(fit["coefficients"], ml.stages[-1].coefficients.toArray(), rtol=0, atol=1e-9)
    assert abs(fit["intercept"] - ml.stages[-1].intercept) < 1e-9 and fit["n"] == tr.count()
    both = M.solved_model(fit, medians).transform(data).select("source_result_id", "predicted_z").join(
        ml.transform(data).select("source_result_id", F.col("predicted_z").alias("ml")), "source_result_id")
    assert both.agg(F.max(F.abs(F.col("predicted_z") - F.col("ml")))).first()[0] < 1e-9
    early = [r for r in rows if r["year"] < 1997]
    again = M.solve(M.moments(tr.where("year < 1997"), medians).collect(), medians)
    assert np.allclose(M.solve(early, medians)["coefficients"], again["coefficients"], atol=1e-12)


def test_medians_and_constant_columns(spark):
    rng = np.random.default_rng(3)
    n = 3001
    frame = {"a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float), "c": np.full(n, 7.0), "d": rng.normal(size=n), "e": rng.normal(size=n)}
    frame["d"][::3] = np.nan
    rows = [tuple(None if x != x else float(x) for x in r) for r in zip(*frame.values())]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").withColumn("none", F.lit(None).cast("double"))
    cols = ["a", "b", "c", "d", "none"]
    want = {c: float(np.nanmedian(frame[c])) for c in "abcd"} | {"none": None}
    for few in (10**6, 500, 1):                                    # fetched at once, after one narrowing, as far as it goes
        assert M.exact_medians(df, cols, few) == want
    assert M.exact_medians(df.where("a IS NULL"), cols)["a"] is None
    data = df.withColumn("year", F.lit(2000)).withColumn("target_z", 2 * F.col("a") - F.col("e"))
    fit = M.solve(M.moments(data, want, ["a", "c", "none"]).collect(), want, ["a", "c", "none"])
    assert fit["coefficients"][1] == fit["coefficients"][2] == 0 and abs(fit["coefficients"][0] - 2 * np.std(frame["a"], ddof=1)) < 0.1
    assert M.solved_model(fit, want, ["a", "c", "none"]).transform(data).where("predicted_z IS NULL").count() == 0
