"""Importance resampling of documents towards a target distribution.

An untrained pre-tokeniser (a ``tokenizers`` Split on a regular expression) cuts the ASCII-lowered text
into words with their offsets. Windows over consecutive offset pairs are the features: every run of 1 to
``n`` words, joined by one space. A feature falls into the bucket of its CRC-32. Two histograms of
buckets, one over all documents and one over all texts of the target, give each bucket a gain (the log
ratio of its smoothed shares), and a document's weight is the mean gain of its features. Gumbel noise
drawn from the document's id turns the weights into a seeded draw without replacement: the highest
scores are drawn.

Texts are tokenised once; the buckets of each document are written as a compact table that both the
histogram and the summation read. A histogram has one row per bucket whatever the input, so the gains
are a table of fixed size; ranks come from range partitions of narrow rows, never from one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_index
from .common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Windows(dict):
    """Buckets of the features of texts; known features are remembered up to ``size`` of them."""

    def __init__(self, n: int, buckets: int, size: int = 1 << 18):
        from tokenizers import Regex, pre_tokenizers
        super().__init__()
        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.n, self.buckets, self.size = n, buckets, size

    def __missing__(self, feature: str) -> int:
        if len(self) >= self.size:
            self.clear()
        self[feature] = at = zlib.crc32(feature.encode()) % self.buckets
        return at

    def of(self, text: bytes) -> tuple[int, np.ndarray]:
        """The number of words of a text and the buckets of its features, repeats included."""
        lowered = text.lower().decode("utf-8", "replace")              # bytes lower only A-Z
        offsets = [at for _, at in self.split.pre_tokenize_str(lowered)]
        words = [lowered[a:b] for a, b in offsets]
        got = [np.fromiter(map(self.__getitem__, words), np.uint32, len(words))]
        for k in range(2, min(self.n, len(words)) + 1):
            runs = (" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
            got.append(np.fromiter(map(self.__getitem__, runs), np.uint32, len(words) - k + 1))
        return len(words), np.concatenate(got)


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucketed(rows: DataFrame, text_col: str, n: int, buckets: int) -> DataFrame:
    """``rows`` with the text replaced by ``n_words``, ``n_features`` and the packed ``buckets`` of its
    features (null text: none). The names must be free in ``rows``."""
    kept = [c for c in rows.columns if c != text_col]
    kind = _width(buckets)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = Windows(n, buckets)
        for f in frames:
            got = [windows.of(t) for t in f[text_col]]
            yield f[kept].assign(n_words=[w for w, _ in got], n_features=[len(b) for _, b in got],
                                 buckets=[b.astype(kind).tobytes() for _, b in got])
    packed = rows.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != text_col)
    return packed.mapInPandas(run, types + "n_words long, n_features long, buckets binary")


def histogram(table: DataFrame, buckets: int) -> np.ndarray:
    """Number of features in each bucket of a table of :func:`bucketed`: a row per bucket and task is
    shuffled, a number per bucket reaches the driver."""
    kind = _width(buckets)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(buckets, np.int64)
        for f in frames:
            for b in f["buckets"]:
                n += np.bincount(np.frombuffer(b, kind), minlength=buckets)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"bucket": at, "n": n[at]})
    found = table.select("buckets").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy(int)] = found["n"].to_numpy(int)
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B))))`` of every bucket, in doubles."""
    b = len(raw)
    ratio = (target + 1.0) * (raw.sum() + float(b)) / ((raw + 1.0) * (target.sum() + float(b)))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def gumbel(id_col: Column, seed: int) -> Column:
    """The seeded noise of an id, floored to thousandths (null: that of the empty id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, min_words: int = 20, percent: int = 10,
             seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every row of ``docs``, by its id.

    Of the N rows with ``min_words`` words at least, ``floor(percent * N / 100)`` are drawn: those with the
    highest scores, ties to the smaller id (null ids last), then to fewer features and the smaller
    weight, so that repeated rows, which tie in all, take consecutive ranks. Rank is null for all
    others. Null and empty texts have no features and weight 0; empty tables give an empty result or, as
    targets, equal gains. Other columns of ``docs`` are not read, whatever their names.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = stored(bucketed(own, "text", n, buckets), "importance-buckets")
    aim = bucketed(target.select(F.col(target_text).alias("text")), "text", n, buckets)
    gain, kind = gains(histogram(table, buckets), histogram(aim, buckets)), _width(buckets)

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sums = [int(gain[np.frombuffer(b, kind)].sum()) for b in f["buckets"]]
            yield f[["id", "n_words", "n_features"]].assign(weight=[s // k if k else 0 for s, k in zip(sums, f["n_features"])])
    rows = table.mapInPandas(weigh, f"id {table.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")
    rows = rows.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    able = F.col("n_words") >= min_words
    drawn = table.where(able).count() * percent // 100
    placed = global_index(rows, [(~able).cast("int"), -F.col("score"), F.col("id").isNull().cast("int"), F.col("id"), F.col("n_features"), F.col("weight")])
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score",
                         F.when(able & (F.col("idx") < drawn), F.col("idx") + 1).cast("long").alias("rank"))
