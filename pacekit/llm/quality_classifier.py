"""Quality scores by hierarchical empirical Bayes.

Three levels of evidence meet. A logistic classifier judges each document by its own text. Grouped
aggregations over all documents give every path (here: a source's language) and host (here: the
source) its share of good documents, counting the known labels and, for the others, the
classifier's probability. Shares of sparse sites are unreliable, so a path is shrunk towards its
host and a host towards the global share with beta priors whose strength is fitted to the spread
between the hosts, or paths, by moments. The document's odds are then multiplied by the odds of
its path relative to the global odds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch_columns, stored
from .toxicity import fit_curve, fold, held_out

FEATURES = ("words", "length", "symbols", "capitals", "digits", "marks", "bars", "repeats", "lines", "breaks", "runs", "stops")
_SYMBOLS, _CAPITALS, _DIGITS, _MARKS = rb"#*$%&<>{}\^~=_", bytes(range(65, 91)), bytes(range(48, 58)), b"!?"


def features(text: bytes) -> list[float]:
    """Shares and rates of a whole text; all zero for one without words."""
    ws = text.split()
    n, size = len(ws), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    def share(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / size
    lines = [s for s in text.split(b"\n") if s.strip()]
    letters = sum(map(len, ws))
    runs = sum(a == b for a, b in zip(ws, ws[1:])) / n
    return [float(np.log1p(n)), min(letters / n, 40.0), min(share(_SYMBOLS) * 10, 5.0), share(_CAPITALS) * 5, share(_DIGITS) * 5,
            min(share(_MARKS) * 20, 5.0), min(text.count(b"|") / n * 2, 3.0), 1 - len(set(ws)) / n, 1 - len(set(lines)) / len(lines),
            min(len(lines) / n * 5, 3.0), runs * 3, min(text.count(b".") / n * 5, 3.0)]


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def _strength(mean: float, spread: float) -> float:
    """Prior observations of a beta with this mean whose variance is ``spread``, within 2 and 1000."""
    return min(max(mean * (1 - mean) / spread - 1, 2.0), 1000.0) if spread > 0 else 1000.0


def site_rates(rows: DataFrame) -> DataFrame:
    """``(host, path, host_rate, path_rate, overall)`` from ``rows(host, path, good)``, shrunk level by level."""
    paths = stored(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good")), "hosts")
    n, good = hosts.agg(F.coalesce(F.sum("host_n"), F.lit(0)), F.coalesce(F.sum("host_good"), F.lit(0.0))).first()
    overall = (good + 0.5) / (n + 1.0)
    own = F.col("host_good") / F.col("host_n")
    # the spread between hosts less what chance alone gives their sizes
    chance = F.lit(overall * (1 - overall)) / F.col("host_n")
    between = hosts.agg(F.sum(F.col("host_n") * ((own - F.lit(overall)) ** 2 - chance)) / F.sum("host_n")).first()[0] or 0.0
    s = _strength(overall, max(between, 0.0))
    hosts = hosts.withColumn("host_rate", (F.col("host_good") + s * overall) / (F.col("host_n") + s))
    joined = paths.join(hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    chance = F.col("host_rate") * (1 - F.col("host_rate")) / F.col("n")
    within = joined.agg(F.sum(F.col("n") * ((F.col("good") / F.col("n") - F.col("host_rate")) ** 2 - chance)) / F.sum("n")).first()[0] or 0.0
    t = _strength(overall, max(within, 0.0))
    return joined.select("host", "path", "host_rate", ((F.col("good") + F.lit(t) * F.col("host_rate")) / (F.col("n") + F.lit(t))).alias("path_rate"),
                         F.lit(overall).alias("overall"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
             path_col: str = "lang", label_col: str = "quality", sample: int = 20_000, keep_from: float = 0.2) -> DataFrame:
    """``(doc_id, held_out, score, predicted, kept, text_score, host_rate, path_rate)`` for every row.

    Labels are read only from rows outside the held-out fold. The classifier is fitted on the
    ``sample`` labelled rows with the smallest CRC-32 of their id (a documented bound); the sites'
    shares cover all documents. ``predicted`` is 1 from a score of 0.5, ``kept`` true from
    ``keep_from``. Null and empty texts have no words and are judged by that; null hosts and
    paths are sites of their own; ids with two labels count with their mean; without any label
    every score is 0.5; an empty table gives no rows.
    """
    c_id, c_text, c_label = scratch_columns(docs, "_id", "_text", "_label")
    marks = (labels.select(F.col(id_col).alias("_key"), F.col(label_col).cast("double").alias("_y"))
                   .where("_y in (0, 1)").groupBy("_key").agg(F.avg("_y").alias("_y")).where(~held_out(F.col("_key"))))
    marks = stored(marks, "quality-marks")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[["doc_id", "host", "path"]].assign(x=[features(bytes(t)) for t in f["text"]])
    measured = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                                  F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
                          .mapInPandas(run, "doc_id long, host string, path string, x array<double>"), "quality-features")
    rows = stored(measured.join(marks, F.col("doc_id") == F.col("_key"), "left").drop("_key"), "quality-rows")
    known = (rows.where("_y IS NOT NULL").select("doc_id", "x", F.when(F.col("_y") >= 0.5, 1.0).otherwise(0.0).alias("y"), fold(F.col("doc_id")).alias("f"))
                 .orderBy("f", "doc_id").limit(sample).toPandas())
    x = np.array(known["x"].to_list(), float).reshape(-1, len(FEATURES))
    centre, spread = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    spread[spread == 0] = 1.0
    beta = fit_curve((x - centre) / spread, known["y"].to_numpy(float), ridge=5.0)
    weight = beta[1:] / spread
    start = float(beta[0] - weight @ centre)
    margin = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(b)) for b in weight]), lambda a, b: a * b), F.lit(start), lambda s, v: s + v)
    scored = rows.withColumn("text_score", 1 / (1 + F.exp(-margin))).withColumn("good", F.coalesce("_y", "text_score"))
    sites = stored(site_rates(scored.select("host", "path", "good")), "sites").select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "host_rate", "path_rate", "overall")
    both = scored.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    score = 1 / (1 + F.exp(-(_logit(F.col("text_score")) + _logit(F.col("path_rate")) - _logit(F.col("overall")))))
    return both.withColumn("score", score).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= keep_from).alias("kept"), "text_score", "host_rate", "path_rate")
