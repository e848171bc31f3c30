"""Registry of named queries (Spark) and their SQL oracles (DuckDB).

Every query reads the driver's tables (through the adapters) in full.
Floating results are rounded to 6 decimals on both sides before comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_DOUBLES: dict[str, tuple[str, ...]] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name) for f in df.schema.fields])


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    """Decorator: register a Spark query and (optionally) its oracle SQL.

    ``doubles`` lists the oracle's floating columns, rounded like the Spark side.
    """
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            if doubles:
                rep = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
                ORACLES[name] = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"
            else:
                ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import queries_core, queries_reports, queries_cleaning, queries_resolve, queries_profiling, queries_model, queries_warehouse, queries_shred, queries_streaming, queries_events, queries_files  # noqa: F401
