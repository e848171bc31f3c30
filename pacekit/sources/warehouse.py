"""Star-schema sinks on catalogue tables.

A warehouse is a schema of the session's catalogue, its files below the shared folder. Tables are written with
``saveAsTable`` and ``INSERT``; commits, replaced partitions and added columns are Spark's own.

Dimension loads are get-or-create: the batch's distinct natural keys are joined once with the
stored dimension; keys without a match get ids that continue after the last one given (a small
list, a row per load), numbered by a distributed global index. The fact lookups then use the batch's
own key table, so a load reads each dimension once. Facts are partitioned by year, so
that loads and reports read the years they need, and bucketed by runner, so that what groups, joins or
windows by runner needs no exchange of the stored side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_checked
from ..operators.ranking import global_index
from ..session import cut_lineage, scratch_path

DIM_RUNNER = "dim_runner"
DIM_RACE = "dim_race"
FACT = "fact_results"
ANALYSIS = "fact_runner_race_analysis"
IDS = "given_ids"
BUCKETS = 8                              # of the fact table; sized to the cluster by the caller
PREDICTION_COLUMNS = ["predicted_z", "predicted_performance_index", "predicted_speed_kmh",
                      "predicted_time_sec", "abs_error_time_sec", "split"]
PREDICTION_TYPES = {c: "double" for c in PREDICTION_COLUMNS[:-1]} | {"split": "string"}

# Order that defines "first seen" and the order facts are appended in.
ROW_ORDER = ["Date", "racekey", "source_file", "Position", "Nom"]


def new_warehouse(spark: SparkSession) -> str:
    """A fresh schema for tables; its files lie below the shared folder."""
    name = f"warehouse_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{scratch_path(spark, name)}'")
    return name


def table_exists(spark: SparkSession, root: str | None, name: str) -> bool:
    """Does the catalogue have the table?"""
    return spark.catalog.tableExists(f"`{root}`.`{name}`" if root else name)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return spark.table(f"{root}.{name}") if table_exists(spark, root, name) else None


def write_table(df: DataFrame, root: str, name: str, mode: str = "append", partition: str | None = None, bucket: str | None = None,
           buckets: int = BUCKETS) -> None:
    """Write to a catalogue table, laid out as it was created."""
    w = (df.repartition(buckets, bucket) if bucket else df).write.mode(mode).format("parquet")
    w = w.partitionBy(partition) if partition else w
    (w.bucketBy(buckets, bucket).sortBy(bucket) if bucket else w).saveAsTable(f"{root}.{name}")


def by_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows dealt by the column their files are laid out by: small partitions of the table are one file, large
    ones are cut into several by Spark, so that the few years there are do not bound the tasks."""
    return df.hint("rebalance", F.col(column))


def _last_id(spark: SparkSession, root: str, name: str) -> int:
    """The largest id given so far in a table."""
    noted = read_table(spark, root, IDS)
    return (noted.where(F.col("name") == name).agg(F.max("last")).first()[0] or 0) if noted is not None else 0


def _note_last_id(spark: SparkSession, root: str, name: str, last: int | None) -> None:
    if last is not None:
        write_table(spark.range(1).select(F.lit(name).alias("name"), F.lit(last).cast("long").alias("last")), root, IDS)


def get_or_create(spark: SparkSession, root: str, name: str, rows: DataFrame, key: str, attrs: dict[str, str], id_col: str,
                  order: list[str] = ROW_ORDER) -> DataFrame:
    """Append dimension rows for unseen keys; ``(key, id)`` of the batch's keys.

    A new key's attributes come from the first row seen. The stored dimension is read once, its key
    and id columns only.
    """
    kname = attrs.get(key, key)
    firsts = rows.groupBy(F.col(key).alias(kname)).agg(
        F.min_by(F.struct(*[F.col(src).alias(dst) for src, dst in attrs.items() if src != key]), F.struct(*order)).alias("_a"))
    stored, known = read_table(spark, root, name), None
    if stored is not None:
        matched = cut_lineage(firsts.join(stored.select(kname, id_col), kname, "left"))       # a row per key of the batch
        known = matched.where(F.col(id_col).isNotNull()).select(kname, id_col)
        firsts = matched.where(F.col(id_col).isNull()).drop(id_col)
    start = _last_id(spark, root, name)
    fresh = global_index(firsts, [kname], "_i").withColumn(id_col, (F.col("_i") + F.lit(start) + 1).cast("long"))
    seen = Observation()
    write_table(fresh.select(id_col, kname, "_a.*").observe(seen, F.max(id_col).alias("last")), root, name)
    _note_last_id(spark, root, name, seen.get["last"])
    fresh = fresh.select(kname, id_col)
    return fresh if known is None else known.unionByName(fresh)


def load_star(spark: SparkSession, root: str, clean: DataFrame, dedup: bool = True) -> dict[str, DataFrame]:
    """Dims get-or-create, then fact append with two key lookups.

    ``clean`` needs Nom, Nom_clean, Sexe, racekey, NomCourse, Distance, Date, year,
    Position, `Position Catégorie`, temps_sec, speed_kmh, Categorie,
    categorie_cleaned, source_file.  ``dedup=True`` skips facts already stored
    for the same (race, runner, source file); ``dedup=False`` appends blindly
    as the reference does.  The batch is fixed once (a checkpoint): both key tables, the years and the
    lookups read it.
    """
    clean = cut_lineage(clean.select("Nom", "Nom_clean", "Sexe", "racekey", "NomCourse", "Distance", "Date", "year", "Position", "Position Catégorie",
                                     "temps_sec", "speed_kmh", "Categorie", "categorie_cleaned", "source_file"))
    runners = get_or_create(spark, root, DIM_RUNNER, clean, "Nom_clean",
                            {"Nom_clean": "name_clean", "Nom": "name_origin", "Sexe": "sex"}, "runner_id")
    races = get_or_create(spark, root, DIM_RACE, clean, "racekey",
                          {"racekey": "racekey", "NomCourse": "name", "Distance": "distance", "Date": "date",
                           "year": "year"}, "race_id")
    f = join_checked(clean, runners.withColumnRenamed("name_clean", "Nom_clean"), "Nom_clean")
    f = join_checked(f, races, "racekey")
    facts = f.select(
        "runner_id", "race_id", F.col("Position").alias("position"),
        F.col("Position Catégorie").alias("position_category"), F.col("temps_sec").alias("time_sec"),
        "speed_kmh", F.col("Categorie").alias("category_seen"), F.col("categorie_cleaned").alias("category_clean"),
        "source_file", F.coalesce(F.year("Date"), F.lit(0)).alias("load_year"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(ROW_ORDER)])
    stored = read_table(spark, root, FACT)
    if stored is not None and dedup:
        # a race lies in one year: only the partitions of the batch's years are read
        years = [r[0] for r in clean.select(F.coalesce(F.year("Date"), F.lit(0))).distinct().collect()]
        facts = facts.join(stored.where(F.col("load_year").isin(years)).select("runner_id", "race_id", "source_file").distinct(),
                           ["runner_id", "race_id", "source_file"], "left_anti")
    start = _last_id(spark, root, FACT)
    order = [f"_o{i}" for i in range(len(ROW_ORDER))] + ["runner_id"]
    facts = global_index(facts, order, "_i").withColumn("result_id", (F.col("_i") + F.lit(start) + 1).cast("long"))
    columns = ["result_id", "runner_id", "race_id", "position", "position_category", "time_sec",
               "speed_kmh", "category_seen", "category_clean", "source_file"]
    seen = Observation()
    write_table(facts.select(*columns, "load_year").observe(seen, F.max("result_id").alias("last")), root, FACT,
           partition="load_year", bucket="runner_id")
    _note_last_id(spark, root, FACT, seen.get["last"])
    return {"dim_runner": spark.table(f"{root}.{DIM_RUNNER}"), "dim_race": spark.table(f"{root}.{DIM_RACE}"),
            "fact_results": spark.table(f"{root}.{FACT}").select(*columns)}


def _staged(spark: SparkSession, root: str, name: str, df: DataFrame) -> DataFrame:
    """Rows written to a table of their own first: ``df`` may read what is overwritten next, and if it
    fails nothing has changed."""
    write_table(df, root, f"{name}_staged", "overwrite")
    return spark.table(f"{root}.{name}_staged")


def replace_table(spark: SparkSession, root: str, name: str, df: DataFrame) -> DataFrame:
    """Replace a table, columns included, by Spark's overwrite."""
    rows = _staged(spark, root, name, df)
    write_table(rows, root, name, "overwrite")
    spark.sql(f"DROP TABLE `{root}`.`{name}_staged`")
    return spark.table(f"{root}.{name}")


def truncate_and_load(spark: SparkSession, root: str, name: str, df: DataFrame, dynamic: bool = False) -> DataFrame:
    """Replace a table's rows, keeping only the columns that the table knows (missing ones are NULL).

    With ``dynamic`` only the partitions that ``df`` has rows for are replaced.
    """
    columns = spark.table(f"{root}.{name}").columns
    rows = _staged(spark, root, name, df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns]))
    mode, kept = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(mode, "dynamic" if dynamic else "static")
    try:
        rows.write.mode("overwrite").insertInto(f"{root}.{name}")
    finally:
        spark.conf.set(mode, kept)
    spark.sql(f"DROP TABLE `{root}`.`{name}_staged`")
    return spark.table(f"{root}.{name}")


def add_columns(spark: SparkSession, root: str, name: str, columns: dict[str, str]) -> DataFrame:
    """Evolve a stored table: add the columns it lacks; rows stored before read as NULL there."""
    known = {c.lower() for c in spark.table(f"{root}.{name}").columns}
    fresh = [f"`{c}` {t}" for c, t in columns.items() if c.lower() not in known]
    if fresh:
        spark.sql(f"ALTER TABLE `{root}`.`{name}` ADD COLUMNS ({', '.join(fresh)})")
    return spark.table(f"{root}.{name}")


def append_rows(spark: SparkSession, root: str, name: str, df: DataFrame) -> DataFrame:
    """Append to a stored table by column name; columns that ``df`` lacks are NULL, ones the table lacks are left out."""
    columns = spark.table(f"{root}.{name}").columns
    df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns]).write.insertInto(f"{root}.{name}")
    return spark.table(f"{root}.{name}")


def write_epoch(spark: SparkSession, root: str, name: str, df: DataFrame, epoch: int) -> DataFrame:
    """What a micro-batch adds to a table, in a partition of its own that a replay of the batch overwrites."""
    rows = df.withColumn("epoch", F.lit(epoch).cast("long"))
    if not table_exists(spark, root, name):
        write_table(rows, root, name, partition="epoch")
        return spark.table(f"{root}.{name}")
    return truncate_and_load(spark, root, name, rows, dynamic=True)


def load_analysis(spark: SparkSession, root: str, features: DataFrame) -> DataFrame:
    """The analysis fact with surrogate analysis_id, a partition per year, loaded anew; prediction
    columns are added to the stored table and empty."""
    f = global_index(features, ["source_result_id"], "_i").withColumn("analysis_id", (F.col("_i") + 1).cast("long")).drop("_i")
    if table_exists(spark, root, ANALYSIS):
        return truncate_and_load(spark, root, ANALYSIS, f)
    write_table(by_partition(f, "year"), root, ANALYSIS, partition="year")
    return add_columns(spark, root, ANALYSIS, PREDICTION_TYPES)


def write_back_predictions(spark: SparkSession, root: str, predictions: DataFrame, years: list[int] | None = None) -> tuple[DataFrame, int]:
    """Reset the six prediction columns, then update by analysis_id (else source_result_id).

    Expressed as: drop the columns, left join the predictions on the key, overwrite the partitions
    read. With ``years`` only those partitions are reset, updated and written. Returns the table and its number
    of rows with a prediction.
    """
    table = spark.table(f"{root}.{ANALYSIS}")
    key = "analysis_id" if "analysis_id" in predictions.columns else "source_result_id"
    # of several predictions for a key the largest by z, then by the other columns, is stored
    p = predictions.groupBy(key).agg(F.max(F.struct("predicted_z", *[c for c in PREDICTION_COLUMNS if c != "predicted_z"])).alias("_p"))
    p = p.select(key, *[F.col(f"_p.{c}").alias(c) for c in PREDICTION_COLUMNS])
    base = (table if years is None else table.where(F.col("year").isin(years))).drop(*PREDICTION_COLUMNS)
    new = truncate_and_load(spark, root, ANALYSIS, by_partition(base.join(p, key, "left"), "year"), dynamic=years is not None)
    return new, new.where(F.col("predicted_z").isNotNull()).count()


def drop_warehouse(spark: SparkSession, root: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{root}` CASCADE")
