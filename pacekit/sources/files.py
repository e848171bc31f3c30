"""File-level sources and sinks.

Archives and documents are read with Spark's ``binaryFile`` source; archive
members are expanded inside tasks with ``mapInPandas`` (zipfile), so archives
are processed in parallel and nothing passes through the driver.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MEMBER_SCHEMA = ("archive string, member string, name string, size long, content binary, error string")


def _expand(batches):
    for pdf in batches:
        out = []
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for info in zf.infolist():
                        if info.is_dir():
                            continue
                        base = info.filename.rsplit("/", 1)[-1]
                        out.append((path, info.filename, base, info.file_size, zf.read(info), None))
            except Exception as exc:  # one bad archive must not stop the others
                out.append((path, None, None, None, None, f"{type(exc).__name__}: {exc}"))
        yield pd.DataFrame(out, columns=["archive", "member", "name", "size", "content", "error"])


def expand_archives(spark: SparkSession, input_dir: str) -> DataFrame:
    """Every member of every ``*.zip`` below ``input_dir`` (recursive), flattened to its base name.

    On a name clash the first writer wins (archive path, then member path);
    rows for damaged archives carry ``error``.
    """
    z = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.zip").load(input_dir).select("path", "content"))
    members = z.mapInPandas(_expand, MEMBER_SCHEMA)
    w = Window.partitionBy("name").orderBy("archive", "member")
    return members.withColumn("_rank", F.when(F.col("name").isNotNull(), F.row_number().over(w))) \
                  .withColumn("status", F.when(F.col("error").isNotNull(), "FAILED")
                                         .when(F.col("_rank") == 1, "EXTRACTED").otherwise("SKIPPED")) \
                  .drop("_rank")


def extraction_report(members: DataFrame) -> DataFrame:
    """Extracted / skipped / failed counts and total bytes extracted."""
    return members.agg(F.count_if(F.col("status") == "EXTRACTED").alias("extracted"),
                       F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
                       F.count_if(F.col("status") == "FAILED").alias("failed"),
                       F.coalesce(F.sum(F.when(F.col("status") == "EXTRACTED", F.col("size"))), F.lit(0))
                        .cast("long").alias("total_bytes"))


def list_documents(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """S3: documents of a folder (recursive) with their size, sorted by path."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
                 .load(folder).select("path", "length", "modificationTime").orderBy("path"))


def not_yet_done(docs: DataFrame, manifest: DataFrame | None, key: str = "source_file") -> DataFrame:
    """Skip documents whose output already exists (manifest of done files)."""
    return docs if manifest is None else docs.join(manifest.select(key), key, "left_anti")


def consolidate(spark: SparkSession, folder: str) -> DataFrame:
    """Read every Parquet file of a folder as one table (schemas merged)."""
    return spark.read.option("mergeSchema", "true").parquet(folder)
