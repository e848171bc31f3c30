"""Model job: prepare -> temporal split -> exact-median impute -> scale -> OLS -> predict -> metrics.

(M1-M8, M10, A24, A25, S8, S19) with Spark ML; persistence is a PipelineModel
directory plus a one-row metrics table next to it.
"""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import finite_or_null, predicted_from_z
from ..session import cut_lineage, cut_to_files

# The model's input features, in order.
FEATURE_COLUMNS = [
    "distance", "race_month", "race_dayofyear", "prior_race_count", "prior_avg_speed", "prior_std_speed",
    "prior_best_speed", "prior_avg_z", "prior_std_z", "prior_best_z", "recent_speed_roll3", "recent_z_roll3",
    "days_since_last_race", "runner_history_years",
]
# What a prepared row carries besides the features, and what it must have.
_IDENTITY = {"source_result_id": "bigint", "analysis_id": "bigint", "runner_id": "bigint", "race_id": "int", "year": "int"}
_MEASURES = {"race_mean_speed", "race_std_speed", "target_z", "target_time_sec"}
_REQUIRED = ("analysis_id", "race_std_speed", "target_z", "target_time_sec")


def feature_source(df: DataFrame) -> dict[str, str]:
    """Which stored column serves as the row's reference and as its time.

    A row's own ``result_id`` replaces a stored reference; the time is ``target_time_sec``, else
    ``time_sec``, else ``actual_time_sec``. Missing references, distances or times are errors.
    """
    def first(what: str, *names: str) -> str:
        found = next((n for n in names if n in df.columns), None)
        if found is None:
            raise ValueError(f"feature table needs {what}: " + " or ".join(names))
        return found
    first("a distance", "distance")
    return {"source_result_id": first("a reference", "result_id", "source_result_id"),
            "target_time_sec": first("a time", "target_time_sec", "time_sec", "actual_time_sec")}


def prepare_dataset(df: DataFrame) -> DataFrame:
    """P12 + P14: one select of the known columns, infinities and NaN as null, rows without a
    target, time or baseline (or analysis id, where there is one) left out."""
    serves = feature_source(df)
    wanted = dict.fromkeys([*_IDENTITY, *FEATURE_COLUMNS, *sorted(_MEASURES)])
    kinds = dict(df.dtypes)
    out = {}
    for c in wanted:
        stored = serves.get(c, c)
        if stored in kinds:
            value = F.col(stored).cast("double") if c == "target_time_sec" else F.col(stored)
            out[c] = finite_or_null(value) if c == "target_time_sec" or kinds[stored] in ("double", "float") else value
    rows = df.select(*[v.alias(c) for c, v in out.items()])
    return rows.dropna(subset=[c for c in _REQUIRED if c in out])


def temporal_split(data: DataFrame, key: str = "source_result_id", seed: int = 42) -> DataFrame:
    """M2: label rows 'test' for the latest year and 'train' for the years before; rows without a
    year are in neither set (no label). With fewer than two years a deterministic 80/20 split by
    hash of the key."""
    st = data.agg(F.min("year").alias("first"), F.max("year").alias("last")).first()
    if st["last"] is not None and st["first"] < st["last"]:
        return data.withColumn("split", F.when(F.col("year") == st["last"], "test").when(F.col("year") < st["last"], "train"))
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return data.withColumn("split", F.when(bucket < 20, "test").otherwise("train"))


def exact_medians(train: DataFrame, cols: list[str], few: int = 20_000) -> dict[str, float | None]:
    """M3: exact training medians of the feature columns, all in one aggregation a pass, without a row per feature.

    A pass counts, for every column, the values in and below its bracket, and a second one narrows the bracket
    around the middle ranks with a mergeable quantile sketch (whose rank error is known), to some thousandth of
    its values. When at most ``few`` values of each column are left between the brackets, those are fetched.
    """
    v = {c: F.col(c).cast("double") for c in cols}
    bracket: dict[str, tuple[float, float]] = {}
    ranks: dict[str, tuple[int, int]] = {}
    counted: dict[str, tuple[int, int]] = {}
    for _ in range(12):                                                # each pass leaves a thousandth; ties end it sooner
        inside = {c: F.when(v[c].between(F.lit(bracket[c][0]), F.lit(bracket[c][1])), v[c]) if c in bracket else v[c] for c in cols}
        counts = [x for c in cols for x in (F.count(inside[c]), F.count(F.when(v[c] < F.lit(bracket[c][0]), 1)) if c in bracket else F.lit(0))]
        got = train.agg(*[x.alias(f"_{i}") for i, x in enumerate(counts)]).first()
        counted = {c: (got[2 * i], got[2 * i + 1]) for i, c in enumerate(cols)}
        ranks = ranks or {c: ((n - 1) // 2, n // 2) for c, (n, _) in counted.items()}
        if all(n <= few for n, _ in counted.values()):
            break
        sketches = []
        for c in cols:
            n, below = counted[c]
            middle = [(r - below) / max(1, n - 1) for r in ranks[c]]
            margin = [max(0.0, min(1.0, min(middle) - 0.0005)), max(0.0, min(1.0, max(middle) + 0.0005))]
            sketches.append(F.percentile_approx(inside[c], margin, 10_000))
        got = train.agg(*[x.alias(f"_{i}") for i, x in enumerate(sketches)]).first()
        narrowed = {c: (min(q), max(q)) for c, q in zip(cols, got) if q}
        if narrowed == bracket:                                        # one value each, or as near as the sketch gets
            break
        bracket = narrowed
    rows = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), inside[c].alias("v")) for i, c in enumerate(cols)]), lambda x: x["v"].isNotNull())
    left = train.select(F.explode(rows).alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n")).collect()   # few different values a column
    out: dict[str, float | None] = {}
    for i, c in enumerate(cols):
        mine, upto, found = sorted((r["v"], r["n"]) for r in left if r["i"] == i), counted[c][1], []
        for value, n in mine:
            found += [value] * sum(upto <= r < upto + n for r in ranks[c])
            upto += n
        out[c] = sum(found) / 2 if found else None
    return out


def moments(data: DataFrame, medians: dict[str, float | None], features: list[str] = FEATURE_COLUMNS, y: str = "target_z") -> DataFrame:
    """M3-M5: the sufficient statistics of the fit, one additive row per year.

    ``n``, and ``s``: the sums of the imputed features and the target, and of their products, all features taken
    from their medians (so that the sums stay small). Rows of any years add up to the fit over them.
    """
    z = [F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) - F.lit(medians[c]) if medians[c] is not None else F.lit(0.0) for c in features]
    z.append(F.col(y))
    sums = [F.sum(a) for a in z] + [F.sum(a * b) for i, a in enumerate(z) for b in z[i:]]
    return data.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s"))


def solve(rows, medians: dict[str, float | None], features: list[str] = FEATURE_COLUMNS) -> dict:
    """The fit over merged rows of :func:`moments`: coefficients on features scaled to sample std 1, and the intercept.

    A constant feature has coefficient 0; of features that depend on each other the smallest solution is taken.
    """
    k = len(features)
    n, s = sum(r["n"] for r in rows), np.sum([r["s"] for r in rows], axis=0)
    mean, products = s[:k + 1] / n, np.zeros((k + 1, k + 1))
    products[np.triu_indices(k + 1)] = s[k + 1:]
    centred = np.triu(products) + np.triu(products, 1).T - n * np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(centred)[:k], 0) / max(n - 1, 1))
    std[std <= 1e-9 * (1 + np.abs(mean[:k]))] = 0.0
    scale = np.divide(1.0, std, out=np.zeros(k), where=std > 0)
    beta = np.linalg.lstsq(centred[:k, :k] * np.outer(scale, scale), centred[:k, k] * scale, rcond=1e-13)[0]
    middle = np.array([medians[c] or 0.0 for c in features]) + mean[:k]
    return {"n": int(n), "coefficients": beta, "intercept": float(mean[k]), "means": middle, "scale": scale}


def solved_model(fit: dict, medians: dict[str, float | None], features: list[str] = FEATURE_COLUMNS) -> PipelineModel:
    """The fit as a persistable pipeline of one SQL stage: impute, scale and predict."""
    number = lambda x: f"CAST('{float(x)!r}' AS DOUBLE)"
    terms = [f"{number(b * s)} * (coalesce(CAST(`{c}` AS DOUBLE), {number(medians[c])}) - {number(m)})"
             for c, b, s, m in zip(features, fit["coefficients"], fit["scale"], fit["means"]) if medians[c] is not None and b * s]
    model = PipelineModel([SQLTransformer(statement=f"SELECT *, {' + '.join([number(fit['intercept']), *terms])} AS predicted_z FROM __THIS__")])
    model.solved = fit
    return model


def build_pipeline(medians: dict[str, float], features: list[str] = FEATURE_COLUMNS) -> Pipeline:
    """M3-M5 as Spark ML stages: impute -> assemble -> scale -> OLS. The training job fits the same model from
    :func:`moments`; this is the form that a test compares it with, and that takes other estimators."""
    fills = ", ".join(
        f"coalesce(CAST(`{c}` AS DOUBLE), CAST({repr(float(medians[c])) if medians.get(c) is not None else 'NULL'} AS DOUBLE)) AS `_imp_{c}`"
        for c in features)
    impute = SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__")
    assemble = VectorAssembler(inputCols=[f"_imp_{c}" for c in features], outputCol="_x", handleInvalid="keep")
    scale = StandardScaler(inputCol="_x", outputCol="_xs", withMean=True, withStd=True)
    ols = LinearRegression(featuresCol="_xs", labelCol="target_z", predictionCol="predicted_z",
                           regParam=0.0, elasticNetParam=0.0, solver="normal", standardization=False)
    return Pipeline(stages=[impute, assemble, scale, ols])


def predict_time(pred: DataFrame) -> DataFrame:
    """index, speed, time and absolute error that follow from the predicted z."""
    index, speed, time, _ = predicted_from_z("predicted_z", "race_mean_speed", "race_std_speed", "distance")
    return pred.select("*", index.alias("predicted_performance_index"), speed.alias("predicted_speed_kmh"), time.alias("predicted_time_sec"),
                       F.abs(F.col("target_time_sec") - time).alias("abs_error_time_sec"))


def regression_metrics(pred: DataFrame, by: str = "split", y: str = "target_z", yhat: str = "predicted_z",
                       t: str = "target_time_sec", that: str = "predicted_time_sec") -> DataFrame:
    """N, MAE / RMSE / R^2 on z and MAE / RMSE on time per split (R^2 = 1 - SSE/SST)."""
    e, et = F.col(y) - F.col(yhat), F.col(t) - F.col(that)
    return pred.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae_z"), F.sqrt(F.avg(e * e)).alias("rmse_z"),
        (F.lit(1.0) - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2_z"),
        F.avg(F.abs(et)).alias("mae_time_sec"), F.sqrt(F.avg(et * et)).alias("rmse_time_sec"))


def overfitting_gap(metrics: DataFrame) -> DataFrame:
    """R^2 train - test, MAE(time) test - train (pivot of the two metric rows)."""
    p = metrics.groupBy().pivot("split", ["train", "test"]).agg(F.first("r2_z").alias("r2"),
                                                                F.first("mae_time_sec").alias("mae"))
    return p.select((F.col("train_r2") - F.col("test_r2")).alias("r2_z_gap"),
                    (F.col("test_mae") - F.col("train_mae")).alias("mae_time_sec_gap"))


def train(features: DataFrame, features_list: list[str] = FEATURE_COLUMNS) -> dict:
    """M6: the whole training job.  Returns model, predictions (M8), metrics (A24), gap."""
    data = cut_to_files(temporal_split(prepare_dataset(features)).where(F.col("split").isNotNull()))
    tr = data.where(F.col("split") == "train")
    medians = exact_medians(tr, features_list)
    by_year = cut_lineage(moments(tr, medians, features_list))          # a row per year, kept with the result
    fit = solve(by_year.collect(), medians, features_list)
    model = solved_model(fit, medians, features_list)
    pred = predict_time(model.transform(data))
    keep = [c for c in ["analysis_id", "source_result_id", "runner_id", "race_id", "target_z", "target_time_sec",
                        "predicted_z", "predicted_performance_index", "predicted_speed_kmh", "predicted_time_sec",
                        "abs_error_time_sec", "split"] if c in pred.columns]
    pred = cut_to_files(pred.select(*keep))
    metrics = regression_metrics(pred)
    return {"model": model, "predictions": pred, "metrics": metrics, "gap": overfitting_gap(metrics),
            "medians": medians, "features": features_list, "moments": by_year}


def coefficients(model: PipelineModel, features: list[str] = FEATURE_COLUMNS, top: int = 15,
                 population_std: bool = True, n_train: int | None = None):
    """M7: standardised coefficients by absolute value (a 14-row table built from the model).

    Spark scales by the sample std; ``population_std`` rescales by sqrt((n-1)/n)
    to read like a population-std scaler.
    """
    found = model.solved["coefficients"] if hasattr(model, "solved") else model.stages[-1].coefficients
    coefs = [float(c) for c in found]
    if population_std and n_train:
        k = ((n_train - 1) / n_train) ** 0.5
        coefs = [c * k for c in coefs]
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(features, coefs)), "feature string, coefficient double")
    return df.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.desc("abs_coefficient")).limit(top)


def save_artifact(result: dict, path: str) -> str:
    """PipelineModel directory + metrics/feature list as JSON next to it."""
    result["model"].write().overwrite().save(os.path.join(path, "model"))
    spark = SparkSession.getActiveSession()
    meta = {"features": result["features"], "medians": result["medians"],
            "metrics": [r.asDict() for r in result["metrics"].collect()]}  # two rows
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
        os.path.join(path, "meta"))
    return path


def load_artifact(path: str) -> dict:
    """{'ok': False, 'message': ...} when absent, else the model and its metadata."""
    spark = SparkSession.getActiveSession()
    try:
        model = PipelineModel.load(os.path.join(path, "model"))
        meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    except Exception as exc:  # missing or unreadable artifact
        return {"ok": False, "message": f"no model artifact at {path}: {type(exc).__name__}"}
    return {"ok": True, "model": model, **meta}


def actual_vs_predicted(pred: DataFrame) -> DataFrame:
    """Test rows in minutes plus the common axis bounds."""
    t = pred.where(F.col("split") == "test").select(
        "source_result_id", (F.col("target_time_sec") / 60).alias("actual_min"),
        (F.col("predicted_time_sec") / 60).alias("predicted_min"))
    lo, hi = t.agg(F.least(F.min("actual_min"), F.min("predicted_min")),
                   F.greatest(F.max("actual_min"), F.max("predicted_min"))).first()  # two scalars
    return t.withColumn("axis_min", F.lit(lo).cast("double")).withColumn("axis_max", F.lit(hi).cast("double"))
