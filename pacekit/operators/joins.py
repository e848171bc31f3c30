"""Join helpers: size-checked broadcasts and null-safe keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join ``big`` with a side that is *expected* to be small.

    A plain join: Spark broadcasts a side whose size in bytes, estimated at planning or measured by
    AQE at run time, is below ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join is a
    shuffle join, in which AQE splits the hot keys of ``big``. No job runs while the plan is built.
    """
    return big.join(small, on, how)


def join_null_safe(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``join_checked`` on equal columns where null equals null."""
    if not on:
        return big.crossJoin(small)          # one row: the whole table is the group
    renamed = small.select(*[F.col(c).alias(f"_ns_{c}") if c in on else F.col(c) for c in small.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_ns_{c}")) for c in on])
    return big.join(renamed, cond, how).drop(*[f"_ns_{c}" for c in on])
