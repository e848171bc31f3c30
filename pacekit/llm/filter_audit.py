"""Audit of interacting document filters, kept up to date by a stream of files.

Five filters mark a document: A to D by its own text, E when a document with a smaller id has the very
same text. All files go through a structured stream, some files a micro-batch (available now). The state
keeps, for each text (its digest), the smallest id met so far and what that id's rows added to the
counters. When a smaller id arrives, the former one now fails E: its earlier mask is retracted from the
counter of its part and added again with E, and the newcomer's is added without. What reaches the sink are
changes of counters by part, mask and label; a micro-batch's changes are summed and written under its
number, so that a replayed batch overwrites its own and a later call with the same store goes on where the
last one ended.

Texts are the keys of the state, some thousands of them under one key of the stream (a range of digests), so
that a key's rows are updated together, as columns. The number of ranges follows the table and is kept
with the store. A text that a third of all rows share is no hot key: each task first folds its rows of a
text into one row per part and label (their number, the smallest id, the rows at it), so a key meets
as many rows of a text as there are tasks, not documents. Texts are read once and never shuffled.

The report needs the counters only, at most 128 a part: for a filter and the set of filters before it
they give the numbers of every order in which that set comes first.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import scratch_path
from .common import stored

FILTERS = "ABCDE"
_E = 16
_NO_ID = (1 << 63) - 1                                    # a text without an id so far
_COUNTERS = "part string, mask int, quality int, toxic int, n long"
# Settings of the state: on disk, with a bound on memory, written as changes.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",          # many small stores: no space ahead of need
}


def text_mask(text: bytes) -> int:
    """Bits 1, 2, 4, 8 for the filters A to D that a text fails."""
    words = text.split()                                  # bytes split at [\x20\x09-\x0D]+
    points = len(text) - len(re.findall(rb"[\x80-\xBF]", text))
    capitals = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return ((len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words)) + 4 * (100 * capitals > 5 * points)
            + 8 * (re.search(rb"[#$%&*|]", text) is not None))


def _marked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digest and mask of each text; rows without an id get a number of their own, so that they spread."""
    lone = 0
    for f in frames:
        f["mask"] = [text_mask(t) for t in f["text"]]
        f["digest"] = [hashlib.blake2b(t, digest_size=16).hexdigest() for t in f["text"]]
        f["lone"] = 0
        none = f["no_id"].to_numpy()
        f.loc[none, "lone"] = range(lone + 1, lone + 1 + none.sum())
        lone += int(none.sum())
        yield f[["id", "no_id", "lone", "part", "digest", "mask"]]


def _folded(frames: Iterator[pd.DataFrame], most: int = 100_000) -> Iterator[pd.DataFrame]:
    """The rows of a task by text, part and label: how many have an id (``n``) and none (``lone``), the
    smallest id and the rows at it."""
    def rows(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(*k, *v) for k, v in held.items()],
                            columns=["digest", "mask", "part", "quality", "toxic", "n", "lone", "least", "at_least"])
    held: dict[tuple, list] = {}
    for f in frames:
        for digest, mask, part, quality, toxic, i, no_id in zip(f["digest"], f["mask"], f["part"], f["quality"], f["toxic"], f["id"], f["no_id"]):
            got = held.setdefault((digest, mask, part, quality, toxic), [0, 0, _NO_ID, 0])
            if no_id:
                got[1] += 1
                continue
            got[0] += 1
            if i < got[2]:
                got[2:] = i, 1
            elif i == got[2]:
                got[3] += 1
        if len(held) >= most:                             # bounds the memory
            yield rows(held)
            held = {}
    if held:
        yield rows(held)


_KIND = ["digest", "mask", "part", "quality", "toxic"]


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the new rows of a range of texts, and its state: for each text the rows
    of its smallest id (``_KIND``, ``least`` and their number ``n``)."""
    new = pd.concat(frames)
    old = pickle.loads(state.get[0]) if state.exists else pd.DataFrame(columns=[*_KIND, "least", "n"])
    ids = new[new["n"] > 0]
    least = pd.concat([old[["digest", "least"]], ids[["digest", "least"]]]).groupby("digest")["least"].min()
    stays = old["least"].to_numpy() == least.reindex(old["digest"]).to_numpy()
    first = ids[ids["least"].to_numpy() == least.reindex(ids["digest"]).to_numpy()]
    former = old[~stays]

    def change(rows: pd.DataFrame, n: pd.Series, with_e: bool) -> pd.DataFrame:
        return pd.DataFrame({"part": rows["part"], "mask": rows["mask"] + _E * with_e, "quality": rows["quality"], "toxic": rows["toxic"], "n": n})
    changes = pd.concat([
        change(new, new["n"], True), change(new, new["lone"], False),
        change(former, -former["n"], False), change(former, former["n"], True),         # what stood for a former smallest id
        change(first, -first["at_least"], True), change(first, first["at_least"], False)])
    held = pd.concat([old[stays], first.drop(columns=["n"]).rename(columns={"at_least": "n"})[[*_KIND, "least", "n"]]])
    held = held.astype({"mask": int, "quality": int, "toxic": int, "least": "int64", "n": "int64"}).groupby([*_KIND, "least"], as_index=False)["n"].sum()
    state.update((pickle.dumps(held),))
    summed = changes.astype({"mask": int, "quality": int, "toxic": int, "n": "int64"}).groupby(["part", "mask", "quality", "toxic"], as_index=False)["n"].sum()
    yield summed[summed["n"] != 0]


def count_masks(spark: SparkSession, path: str, labels: DataFrame, store: str | None = None, files_per_batch: int = 4, texts_per_key: int = 5000,
                id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Counters ``(part, mask, quality, toxic, n)`` of the documents under ``path``, a Parquet table.

    ``store`` (in the shared folder) keeps the stream's state and the counters: with the same store only
    files that have come since are read. ``texts_per_key`` is the number of texts, on average, whose state is
    updated together. Null texts are empty, null parts are ''; a document without an
    id never fails E and makes none fail; repeated rows of the smallest id all pass E. ``quality`` and
    ``toxic`` are 1 where any label of the id is 1. Other columns are not read.
    """
    store = store or scratch_path(spark, f"llm/audit-{hashlib.blake2b(path.encode(), digest_size=4).hexdigest()}-{spark.sql('SELECT uuid()').first()[0]}")
    deltas = f"{store}/changes"
    spark.createDataFrame([], _COUNTERS).write.mode("overwrite").parquet(f"{deltas}/batch=-1")
    table = spark.read.parquet(path)
    spark.range(1).select(F.lit(table.count() // texts_per_key + 1).alias("ranges")).write.mode("ignore").parquet(f"{store}/ranges")
    ranges = spark.read.parquet(f"{store}/ranges").first()[0]                                # as the store's first call found it
    one = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int"))                                          # noqa: E731
    known = stored(labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
                         .agg(one("quality").alias("quality"), one("toxic").alias("toxic")), "audit-labels")
    # a pattern, so that a table that is one file can be streamed like a folder of files
    files = re.sub(r"([^/]+?)/*$", lambda m: "{" + m[1] + "}", path)
    docs = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch).parquet(files)
                 .select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNull().alias("no_id"),
                         F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")))
    marked = docs.mapInPandas(_marked, "id long, no_id boolean, lone long, part string, digest string, mask int")
    both = marked.join(known.withColumn("label_lone", F.lit(0).cast("long")),
                       (F.col("id") == F.col("label_id")) & (F.col("lone") == F.col("label_lone")), "left")
    both = both.select("id", "no_id", "part", "digest", "mask", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("quality", "toxic")])
    folded = both.mapInPandas(_folded, "digest string, mask int, part string, quality int, toxic int, n long, lone long, least long, at_least long")
    ranged = folded.withColumn("range", F.pmod(F.xxhash64("digest"), F.lit(ranges)))
    changes = ranged.groupBy("range").applyInPandasWithState(_update, _COUNTERS, "texts binary", "append", GroupStateTimeout.NoTimeout)

    def sink(batch: DataFrame, number: int) -> None:
        summed = batch.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{deltas}/batch={number}")
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        (changes.writeStream.foreachBatch(sink).option("checkpointLocation", f"{store}/state")
                .trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return (spark.read.schema(_COUNTERS + ", batch long").parquet(deltas).groupBy("part", "mask", "quality", "toxic")
                 .agg(F.sum("n").alias("n")).where("n <> 0"))


def orders() -> list[tuple[str, int, int, int]]:
    """Every order of the filters: its letters, a step, the step's filter and the set before it, as bits."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[k] for k in order), step, 1 << f, before))
            before |= 1 << f
    return out


def report(counters: DataFrame) -> DataFrame:
    """One row per part, order and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost`` and ``shapley`` (the filter's removals over all orders)."""
    spark, steps = counters.sparkSession, orders()
    pairs = sorted({(f, before) for _, _, f, before in steps})
    times = {p: sum((f, before) == p for _, _, f, before in steps) for p in pairs}
    listed = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(b).alias("before"), F.lit(times[f, b]).alias("times")) for f, b in pairs])
    rows = counters.withColumn("_p", F.explode(listed)).select("*", "_p.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("filter")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(holds: Column) -> Column:
        return F.sum(F.when(holds, F.col("n")).otherwise(0))
    removed = fails & ~earlier
    sums = rows.groupBy("part", "filter", "before", "times").agg(
        total(~fails & ~earlier).alias("kept"), total(removed).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("filter")).alias("unique_fails"), total(removed & (F.col("quality") == 1)).alias("good_lost"),
        total(removed & (F.col("toxic") == 1)).alias("toxic_lost"))
    shapley = sums.groupBy(F.col("part").alias("_part"), F.col("filter").alias("_filter")).agg(F.sum(F.col("removed") * F.col("times")).alias("shapley"))
    sums = sums.join(shapley, (F.col("part") == F.col("_part")) & (F.col("filter") == F.col("_filter")))
    plan = spark.createDataFrame(steps, "filter_order string, step int, f int, b int")     # 600 rows, always
    return (sums.join(F.broadcast(plan), (F.col("filter") == F.col("f")) & (F.col("before") == F.col("b")))
                .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, store: str | None = None, files_per_batch: int = 4,
          texts_per_key: int = 5000) -> DataFrame:
    """:func:`report` over the documents under ``path``; no rows for an empty table."""
    return report(stored(count_masks(spark, path, labels, store, files_per_batch, texts_per_key), "audit-counters"))
