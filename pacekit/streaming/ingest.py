"""ST1: incremental ingest of new extracted documents, each processed exactly once, ids from keyed state.

Documents land as files in folders of extracted cells and of page text, under a partition per landing
(``landed=...``). A run takes what has come since the last one, in two streams with ``availableNow``:

* **documents**: a file-source stream over the cells. Each micro-batch reads the pages of its own landings
  only (a pruned partition), shreds and cleans (V1-V10, W12, P1-P9, E1) and writes, under its epoch, the clean
  rows, the parse report and the distinct natural keys that the rows use: files, races, runners.
* **keys**: a stream over those key tables into a stateful operator. The state store holds the id of
  every natural key, spread over shards by hash; a key met for the first time takes the next id of its
  shard. What comes out are the ids of the batch's own keys and which of them are new: new ones are
  appended to the dimensions (S12, S13), and the batch's clean rows are joined with their ids and appended to the
  facts (S14, J11). Files that were there before are left out (S5).

No dimension and no earlier landing is read back, whatever has been loaded before: a batch reads its own
rows, and the state entries of its own keys. Every output has a partition per epoch that a replay
overwrites; ids are deterministic (names in order within a shard, state of the last committed batch), so a
batch that is run again after a failure writes the same rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..operators import cleaning as C
from ..operators import shred as SH
from ..operators.ranking import global_index
from ..plans.profiling import with_derived
from ..session import cut_lineage
from ..sources import warehouse as WH

CELLS_SCHEMA = StructType([
    StructField("source_file", StringType()), StructField("page_no", IntegerType()),
    StructField("table_no", IntegerType()), StructField("row_no", IntegerType()),
    StructField("cells", ArrayType(StringType())), StructField("landed", StringType())])
KEYS_SCHEMA = "kind string, name string, epoch long"
SHARDS = 8
_EPOCH_BITS = 40                         # of a fact's number within its batch
_STATE = {"spark.sql.streaming.stateStore.providerClass":
          "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class GiveIds(StatefulProcessor):
    """The id of each natural key, by kind and shard: given once, kept in the state store.

    The state of a key is one entry of a map, read and written alone; ids of a kind are ``count * shards + shard``.
    """

    def __init__(self, shards: int):
        self.shards = shards

    def init(self, handle: StatefulProcessorHandle) -> None:
        number = StructType([StructField("id", LongType())])
        self.ids = handle.getMapState("ids", StructType([StructField("name", StringType())]), number)
        self.count = handle.getValueState("count", number)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        met: dict[str, set[int]] = {}
        for f in rows:
            for name, epoch in zip(f["name"], f["epoch"]):
                met.setdefault(name, set()).add(int(epoch))
        given = self.count.get()[0] if self.count.exists() else 0
        out = []
        for name in sorted(met):
            known = self.ids.getValue((name,))
            if known is None:
                given += 1
                self.ids.updateValue((name,), (given * self.shards + key[1],))
            first = min(met[name])
            out += [(key[0], name, epoch, known[0] if known else given * self.shards + key[1], known is None and epoch == first) for epoch in sorted(met[name])]
        self.count.update((given,))
        yield pd.DataFrame(out, columns=["kind", "name", "epoch", "id", "fresh"])

    def close(self) -> None:
        pass


_IDS = "kind string, name string, epoch long, id long, fresh boolean"


def process_documents(spark: SparkSession, cells: DataFrame, pages: DataFrame, root: str, work: str, epoch: int) -> None:
    """Batch pipeline for a set of complete documents: clean rows, their natural keys and the parse report, by epoch."""
    out = SH.shred(cells, pages)
    rows = cut_lineage(out["rows"])                                 # of this batch, read by the report and the cleaning
    clean_dir = os.path.join(work, "clean", f"epoch={epoch}")
    clean = with_derived(C.clean_results(C.dedup_results(rows))).drop("temps_clean")
    clean.write.mode("overwrite").parquet(clean_dir)
    clean = spark.read.parquet(clean_dir)
    keys = [clean.select(F.lit(kind).alias("kind"), F.col(c).alias("name")).distinct() for kind, c in
            (("file", "source_file"), ("race", "racekey"), ("runner", "Nom_clean"))]
    keys = keys[0].unionByName(keys[1]).unionByName(keys[2]).where(F.col("name").isNotNull())
    WH.write_epoch(spark, root, "parse_report", SH.reconcile(rows, out["headers"]), epoch)
    # last: what the second stream listens to
    keys.write.mode("overwrite").parquet(os.path.join(work, "keys", f"epoch={epoch}"))


def _first_attributes(rows: DataFrame, key: str, attrs: dict[str, str]) -> DataFrame:
    """A key's attributes from the first row seen."""
    first = F.min_by(F.struct(*[F.col(c).alias(name) for c, name in attrs.items()]), F.struct(*WH.ROW_ORDER))
    return rows.groupBy(key).agg(first.alias("_a")).select(key, "_a.*")


def load_with_ids(spark: SparkSession, given: DataFrame, root: str, work: str, batch: int) -> None:
    """S12-S14 for the batch's keys and the clean rows of their epochs; partition ``batch`` of each table is replaced."""
    given = cut_lineage(given)                                      # a row per key of the batch
    epochs = [r[0] for r in given.select("epoch").distinct().collect()]
    clean = spark.read.parquet(os.path.join(work, "clean")).where(F.col("epoch").isin(epochs))
    of = lambda kind, name, id_name: given.where(F.col("kind") == kind).select(F.col("name").alias(name), "epoch", F.col("id").alias(id_name), "fresh")
    files = of("file", "source_file", "_file").where("fresh").drop("fresh", "_file")
    rows = clean.join(files, ["source_file", "epoch"], "left_semi")
    runners, races = of("runner", "Nom_clean", "runner_id"), of("race", "racekey", "race_id")
    new_runners = (_first_attributes(clean.join(runners.where("fresh"), ["Nom_clean", "epoch"]), "runner_id",
                                     {"Nom_clean": "name_clean", "Nom": "name_origin", "Sexe": "sex"}))
    new_races = (_first_attributes(clean.join(races.where("fresh"), ["racekey", "epoch"]), "race_id",
                                   {"racekey": "racekey", "NomCourse": "name", "Distance": "distance", "Date": "date", "year": "year"}))
    WH.write_epoch(spark, root, WH.DIM_RUNNER, new_runners, batch)
    WH.write_epoch(spark, root, WH.DIM_RACE, new_races, batch)
    f = (rows.join(runners.drop("fresh"), ["Nom_clean", "epoch"]).join(races.drop("fresh"), ["racekey", "epoch"])
             .select("runner_id", "race_id", F.col("Position").alias("position"), F.col("Position Catégorie").alias("position_category"),
                     F.col("temps_sec").alias("time_sec"), "speed_kmh", F.col("Categorie").alias("category_seen"),
                     F.col("categorie_cleaned").alias("category_clean"), "source_file"))
    numbered = global_index(f, ["source_file", "race_id", "runner_id", "position"], "_i")
    WH.write_epoch(spark, root, WH.FACT, numbered.select((F.lit(batch << _EPOCH_BITS) + F.col("_i") + 1).alias("result_id"), *f.columns), batch)


def _set(spark: SparkSession, conf: dict[str, str | None]) -> dict[str, str | None]:
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return before


def run_ingest(spark: SparkSession, cells_dir: str, pages_dir: str, root: str, checkpoint: str, shards: int = SHARDS) -> None:
    """Process everything that has landed and stop. ``root`` is a schema of the catalogue, ``checkpoint`` a shared folder."""
    work = os.path.join(checkpoint, "work")
    documents = spark.readStream.schema(CELLS_SCHEMA).option("maxFilesPerTrigger", 1000).parquet(cells_dir)

    def shred_batch(df: DataFrame, epoch: int) -> None:
        if df.isEmpty():
            return
        landings = [r[0] for r in df.select("landed").distinct().collect()]
        pages = spark.read.parquet(pages_dir).where(F.col("landed").cast("string").isin(landings))
        files = df.select("source_file").distinct()
        process_documents(spark, df.drop("landed"), pages.drop("landed").join(files, "source_file", "left_semi"), root, work, epoch)

    (documents.writeStream.foreachBatch(shred_batch).option("checkpointLocation", os.path.join(checkpoint, "documents"))
              .trigger(availableNow=True).start().awaitTermination())
    # what a run without documents listens to
    spark.createDataFrame([], "kind string, name string").write.mode("ignore").parquet(os.path.join(work, "keys", "epoch=-1"))
    keys = (spark.readStream.schema(KEYS_SCHEMA).parquet(os.path.join(work, "keys"))
                 .withColumn("shard", F.pmod(F.xxhash64("kind", "name"), F.lit(shards)).cast("int")))
    given = keys.groupBy("kind", "shard").transformWithStateInPandas(GiveIds(shards), _IDS, "Append", "None")

    def load_batch(df: DataFrame, batch: int) -> None:
        if not df.isEmpty():
            load_with_ids(spark, df, root, work, batch)
    before = _set(spark, _STATE)
    try:
        (given.writeStream.foreachBatch(load_batch).option("checkpointLocation", os.path.join(checkpoint, "keys"))
              .trigger(availableNow=True).start().awaitTermination())
    finally:
        _set(spark, before)


def drop_documents(cells: DataFrame, pages: DataFrame, cells_dir: str, pages_dir: str, files: DataFrame, landed: str) -> None:
    """Write the given documents into the landing folders (a file per document and folder), under their landing."""
    for rows, folder in ((cells, cells_dir), (pages, pages_dir)):
        rows.join(files, "source_file", "left_semi").repartition("source_file").write.mode("append").parquet(os.path.join(folder, f"landed={landed}"))
