"""Numeric helpers: safe division, clipping, NaN/inf handling, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(x, y) -> Column:
    """``x / NULLIF(y, 0)`` -- null instead of an ANSI divide-by-zero error."""
    return col(x) / F.nullif(col(y), F.lit(0))


def finite_or_null(c) -> Column:
    """NaN and +-inf -> NULL (one null only)."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Apply :func:`finite_or_null` to every floating column."""
    return df.select(*[
        finite_or_null(f.name).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def clip_lower(c, lo: float = 1.0) -> Column:
    """Values below ``lo`` become ``lo``; NULL stays NULL (unlike ``greatest``)."""
    c = col(c)
    return F.when(c < lo, F.lit(lo)).otherwise(c)


def speed_kmh(distance, time_sec) -> Column:
    """km/h; null when the time is 0 or null."""
    return col(distance) / (F.nullif(col(time_sec), F.lit(0)) / 3600.0)


def pace_sec_km(time_sec, distance) -> Column:
    """seconds per km; null when the distance is 0."""
    return safe_div(time_sec, distance)


def speed_step_score(diff) -> Column:
    """F16: |speed difference| -> 100 / 80 / 50 / 0 (null or NaN -> 0)."""
    d = col(diff)
    return (F.when(d < 0.5, 100).when(d < 1, 80).when(d < 2, 50).otherwise(0)).cast("int")


def weighted_score_x10(lcs2, lensum, speed_score) -> Column:
    """F17 in exact integer form: ``round(0.9 * name + 0.1 * speed, 1) * 10``.

    With name = 100 * lcs2 / lensum (lcs2 = 2 * LCS), 10 * final =
    (900 * lcs2 + speed * lensum) / lensum, rounded half to even on the exact
    rational, so Spark and any SQL engine agree bit for bit.
    """
    num = F.lit(900) * col(lcs2).cast("long") + col(speed_score).cast("long") * col(lensum).cast("long")
    den = col(lensum).cast("long")
    q = F.floor(num / den).cast("long")
    r2 = (num - q * den) * 2
    return (F.when(den == 0, F.lit(10) * col(speed_score).cast("long") + 900)
             .when(r2 > den, q + 1)
             .when((r2 == den) & (q % 2 == 1), q + 1)
             .otherwise(q))


def predicted_from_z(z, mean, std, distance):
    """index, speed (clipped >= 1), time and pace from a predicted z."""
    index = F.lit(100.0) + F.lit(10.0) * col(z)
    speed = clip_lower(col(mean) + col(z) * col(std), 1.0)
    time = safe_div(col(distance), speed) * 3600.0
    pace = safe_div(time, distance)
    return index, speed, time, pace
