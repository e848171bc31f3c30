"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WS = "[\\x20\\x09-\\x0D]+"          # the word separators of every contract here
_WS_CHARS = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (the folder may be in any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, tag: str, codec: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it again.

    Later jobs survive lost executors, and Spark knows the size of the table when it
    chooses between a broadcast and a shuffle join.
    """
    path = scratch_path(df.sparkSession, f"llm/{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(table: DataFrame) -> None:
    """Remove a table of :func:`stored` that nothing reads any more."""
    sc = table.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def small(table: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A stored, narrow table marked for broadcast if it has ``max_rows`` at most; else as it is,
    for a shuffle join."""
    return F.broadcast(table) if table.count() <= max_rows else table


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words (null: 0)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(_WS_CHARS))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, WS, -1))).cast("long")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def scratch_columns(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that clash with none of ``df``'s (Spark compares without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        c = n
        while c.lower() in taken:
            c = "_" + c
        taken.add(c.lower())
        out.append(c)
    return out
