"""Session construction and cluster-aware settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.  On a cluster the
# deployer's values win: we only fill in what is unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pacekit", driver_memory: str = "16g",
                  checkpoint: str | None = None) -> SparkSession:
    """Local/test session; on a cluster use the session the platform hands you."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", driver_memory)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint:
        b = b.config("spark.checkpoint.dir", checkpoint)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder).  Only when it is unset -- local runs and tests -- a scratch folder
    is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pacekit-ckpt-")      # one machine: a scratch folder of our own
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_to_files(df):
    """Rows written once as Parquet below the shared folder and read back: a lineage cut that is compressed and read
    by column, which a checkpoint (serialised rows) is not. For wide rows that several branches read in part."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"cuts/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


_STAGES: dict[tuple[str, str], str] = {}


def stage_table(spark: SparkSession, key: str, build) -> "DataFrame":
    """Materialise a pipeline stage once per application as Parquet in the shared folder.

    Later jobs read the written table (a lineage cut that survives executor
    loss), just as the pipeline's stages hand Parquet files to each other.
    """
    import hashlib
    app = spark.sparkContext.applicationId
    k = (app, key)
    if k not in _STAGES:
        path = scratch_path(spark, "stages/" + hashlib.sha1(f"{app}:{key}".encode()).hexdigest()[:16])
        build().write.mode("overwrite").parquet(path)
        _STAGES[k] = path
    return spark.read.parquet(_STAGES[k])
