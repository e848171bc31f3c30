"""Deduplication and last-write-wins as aggregations (map-side combined)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order, ascending: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the one with the smallest (or largest) ``order``.

    ``order`` may be a column name, a Column or a list (compared as a struct).
    Expressed as ``min_by(struct(row), order)``, which Spark partially
    aggregates before the shuffle, so a hot key costs one row per map task
    instead of a whole group in one task.
    """
    if isinstance(order, (list, tuple)):
        ordc = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    else:
        ordc = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if ascending else F.max_by
    return (df.groupBy(*keys)
              .agg(pick(F.struct(*rest), ordc).alias("_row"))
              .select(*keys, "_row.*"))


def last_write_wins(df: DataFrame, key: str, value: str, order) -> DataFrame:
    """dict-assignment semantics: for each key the value written last in ``order``."""
    return keep_first(df.select(key, value, *( [order] if isinstance(order, str) else order)),
                      [key], order, ascending=False).select(key, value)
