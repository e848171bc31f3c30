"""Display formats as column expressions.

Python's ``round`` is half-to-even, hence ``bround``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels the reference shows for missing categories.
NULL_CATEGORY_LABEL = "Non renseignée"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole_seconds(x) -> Column:
    return F.bround(_c(x).cast("double"), 0).cast("long")


def format_time(seconds) -> Column:
    """'' for null; 'H:MM:SS' from one hour on, else 'M:SS'."""
    s = _whole_seconds(seconds)
    h, m, sec = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    return (F.when(_c(seconds).isNull(), F.lit(""))
             .when(h != 0, F.format_string("%d:%02d:%02d", h, m, sec))
             .otherwise(F.format_string("%d:%02d", m, sec)))


def format_pace(seconds_per_km) -> Column:
    """'M:SS/km'."""
    s = _whole_seconds(seconds_per_km)
    return (F.when(_c(seconds_per_km).isNull(), F.lit(""))
             .otherwise(F.format_string("%d:%02d/km", F.floor(s / 60), s % 60)))


def format_signed_time(seconds) -> Column:
    """'+M:SS' when > 0, otherwise '-M:SS' (so 0 gives '-0:00', as the reference)."""
    x = _c(seconds)
    s = F.abs(_whole_seconds(x))
    sign = F.when(x > 0, F.lit("+")).otherwise(F.lit("-"))
    return (F.when(x.isNull(), F.lit(""))
             .otherwise(F.format_string("%s%d:%02d", sign, F.floor(s / 60), s % 60)))


def round_exact(x, digits: int) -> Column:
    """x * 10**digits rounded half-to-even on the *exact* binary value of x (as Python does).

    ``bround``/``format_string`` round the shortest decimal string of the
    double (``10.125`` -> ``10.13`` with HALF_UP); Python formats ``10.12``.
    The exact product x * S is recovered as p + err with a Dekker split, all
    in plain double arithmetic, then the tie test is exact.
    """
    x = _c(x).cast("double")
    scale = float(10 ** digits)
    p = x * scale
    c = x * 134217729.0                      # 2**27 + 1
    hi = c - (c - x)
    lo = x - hi
    err = (hi * scale - p) + lo * scale      # x * scale == p + err exactly
    k0 = F.floor(p)
    d = (p - k0) - 0.5
    s = d + err
    up = F.when(s > 0, 1).when(s < 0, 0).otherwise(F.when(k0 % 2 != 0, 1).otherwise(0))
    return (k0 + up).cast("long")


def format_fixed(x, digits: int) -> Column:
    """Python's ``f"{x:.{digits}f}"`` for finite doubles (null stays null)."""
    k = round_exact(x, digits)
    ak = F.abs(k)
    sign = F.when(_c(x) < 0, F.lit("-")).otherwise(F.lit(""))
    if digits == 0:
        return F.concat(sign, ak.cast("string"))
    div = 10 ** digits
    return F.concat(sign, F.floor(ak / div).cast("string"), F.lit("."),
                    F.lpad((ak % div).cast("string"), digits, "0"))


def race_label(name, year, distance) -> Column:
    """'name - year (d.dd km)'."""
    return F.format_string("%s - %d (%s km)", _c(name), _c(year).cast("int"), format_fixed(distance, 2))


def thousands(n) -> Column:
    """integer with a space as thousands separator."""
    return F.regexp_replace(F.format_number(_c(n).cast("long"), 0), ",", " ")


def speed_label(speed) -> Column:
    """'d.dd km/h' ('' for null)."""
    return F.when(_c(speed).isNull(), F.lit("")).otherwise(F.concat(format_fixed(speed, 2), F.lit(" km/h")))


def position_label(pos) -> Column:
    """integer position or '' when null."""
    return F.coalesce(_c(pos).cast("long").cast("string"), F.lit(""))


def category_label(cat) -> Column:
    """Null category -> fixed label."""
    return F.coalesce(_c(cat), F.lit(NULL_CATEGORY_LABEL))


def index_verdict(index) -> Column:
    """> 101 above, < 99 below, otherwise near (null included)."""
    i = _c(index)
    return F.when(i > 101, F.lit("above")).when(i < 99, F.lit("below")).otherwise(F.lit("near"))


def period_flag(value, active) -> Column:
    """P20: label rows equal to the active value."""
    return F.when(_c(value) == _c(active), F.lit("selected")).otherwise(F.lit("other"))
