"""Parsing helpers for extracted text and cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ascii_lower


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Category patterns (men first) and French month names.
CAT_MEN = r"^(E?SH|JH|V\d+|SE|EH|SEN|V\d+H|VE\d+|SEH|JUH|ESP|H|GAR|DISH)$"
CAT_WOMEN = r"^(E?SF|JF|SD|A\d+|DA|JUF|AI\d+|DAM|SEF|EF|V\d+F|F|FIL|ED|DISF)$"
MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
          "septembre", "octobre", "novembre", "décembre"]
WEEKDAYS = ["lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"]
INVALID_TIMES = ["#VALEUR!"]

_TIME_LIKE = r"^\d{1,2}:\d{2}:\d{2}"


def extract_year(text) -> Column:
    """first 19xx/20xx standing alone, else 0."""
    y = F.regexp_extract(_c(text), r"\b(20\d{2}|19\d{2})\b", 1)
    return F.coalesce(F.when(y != "", y.cast("int")), F.lit(0))


def extract_distance(text) -> Column:
    """first '<number> km' (comma = decimal point), 0 when absent, NULL when malformed."""
    raw = F.regexp_extract(F.lower(_c(text)), r"([\d.,]+)\s*km", 1)
    num = F.regexp_replace(raw, ",", ".")
    valid = num.rlike(r"^(\d+\.?\d*|\.\d+)$")
    return (F.when(_c(text).isNull(), F.lit(None).cast("double"))
             .when(raw == "", F.lit(0.0))
             .when(valid, num.cast("double"))
             .otherwise(F.lit(None).cast("double")))


def extract_date(text) -> Column:
    """'[weekday] d month yyyy' in French (case-insensitive); invalid day -> NULL."""
    pat = (r"(?i)(?:" + "|".join(WEEKDAYS) + r")?\s*(\d{1,2})\s+(" + "|".join(MONTHS) + r")\s+(\d{4})")
    t = _c(text)
    day = F.regexp_extract(t, pat, 1)
    month_name = F.lower(F.regexp_extract(t, pat, 2))
    year = F.regexp_extract(t, pat, 3)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month_name)
    s = F.concat_ws("-", year, month.cast("string"), day)
    return F.when(day != "", F.try_to_timestamp(s, F.lit("y-M-d")).cast("date"))


def has_distance(text) -> Column:
    """Does the text state a distance at all (well-formed or not)?"""
    return F.coalesce(F.regexp_like(F.lower(_c(text)), F.lit(r"[\d.,]+\s*km")), F.lit(False))


def invalid_date(text) -> Column:
    """the text states a date that does not exist."""
    stated = F.regexp_like(_c(text), F.lit(r"(?i)\d{1,2}\s+(" + "|".join(MONTHS) + r")\s+\d{4}"))
    return F.coalesce(stated, F.lit(False)) & extract_date(text).isNull()


def filename_date(name) -> Column:
    """V8: first 8 characters as a date; year-day-month when the name contains the two marker words."""
    head = F.substring(_c(name), 1, 8)
    alt = _c(name).contains("Clavier") | _c(name).contains("solier")
    fmt_a = F.try_to_timestamp(head, F.lit("yyyyddMM")).cast("date")
    fmt_b = F.try_to_timestamp(head, F.lit("yyyyMMdd")).cast("date")
    ok = head.rlike(r"^\d{8}$")
    return F.when(ok, F.when(alt, fmt_a).otherwise(fmt_b))


def sex_from_category(cat) -> Column:
    """H for men's patterns, F for women's, X otherwise."""
    c = F.coalesce(_c(cat), F.lit(""))
    return F.when(c.rlike(CAT_MEN), "H").when(c.rlike(CAT_WOMEN), "F").otherwise("X")


def cell(cells, idx) -> Column:
    """F8: trimmed cell ``idx`` (0-based); '' when missing, null or out of range."""
    i = idx if isinstance(idx, Column) else F.lit(idx)
    v = F.when(i >= 0, F.get(_c(cells), i))
    return F.coalesce(F.trim(v), F.lit(""))


def header_index(cells, keywords: list[str]) -> Column:
    """0-based index of the first cell containing any keyword (ASCII-lowered), else NULL."""
    kws = [k.encode("ascii", "ignore").decode().lower() for k in keywords]
    hit = F.transform(_c(cells), lambda x: F.greatest(*[
        (ascii_lower(x) != "") & ascii_lower(x).contains(k) for k in kws]) if len(kws) > 1
        else (ascii_lower(x) != "") & ascii_lower(x).contains(kws[0]))
    pos = F.array_position(hit, True)
    return F.when(pos > 0, (pos - 1).cast("int"))


def cells_between(cells, start, end) -> Column:
    """cells from ``start`` up to ``end`` (exclusive), blanks dropped; joined by a space unless
    the next part starts lower-case.  No start -> ''; end missing or <= start -> the start cell."""
    arr = _c(cells)
    s, e = _c(start), _c(end)
    part = F.filter(F.transform(F.slice(arr, s + 1, F.greatest(e - s, F.lit(0))),
                                lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != "")
    joined = F.aggregate(
        part, F.lit(None).cast("string"),
        lambda acc, p: F.when(acc.isNull(), p).otherwise(
            F.concat(acc, F.when(F.substring(p, 1, 1).rlike(r"^\p{Ll}$"), F.lit("")).otherwise(F.lit(" ")), p)))
    return (F.when(s.isNull(), F.lit(""))
             .when(e.isNull() | (e <= s), cell(arr, s))
             .otherwise(F.coalesce(F.trim(joined), F.lit(""))))


def parse_duration_parts(text):
    """F11 parts: (hours, minutes, seconds) as numbers, or NULLs when the text is not a duration.

    null / '#VALEUR!' -> null; spaces removed; 'MM:SS' or 'HH:MM:SS'; empty parts
    count as 00; minutes/seconds above 59 are accepted (as pandas does).
    """
    t = F.trim(_c(text))
    t = F.when(~t.isin(*INVALID_TIMES), F.regexp_replace(t, " ", ""))
    parts = F.split(t, ":")
    n = F.size(parts)
    hh = F.when(n == 3, parts[0]).when(n == 2, F.lit("0"))
    mm = F.when(n == 3, parts[1]).when(n == 2, parts[0])
    ss = F.when(n == 3, parts[2]).when(n == 2, parts[1])
    hh, mm, ss = [F.when(x == "", F.lit("0")).otherwise(x) for x in (hh, mm, ss)]  # zfill('') == '00'
    ok = hh.rlike(r"^\d+$") & mm.rlike(r"^\d+$") & ss.rlike(r"^\d+(\.\d+)?$")
    return (F.when(ok, hh.try_cast("long")), F.when(ok, mm.try_cast("long")),
            F.when(ok, ss.try_cast("decimal(20,9)")))


def duration_parts_staged(parts_col: str = "_tparts"):
    """(h, m, s) from an already split ``_tparts`` array column (see ``parse_times``)."""
    parts = F.col("_tparts")
    n = F.size(parts)
    hh = F.when(n == 3, parts[0]).when(n == 2, F.lit("0"))
    mm = F.when(n == 3, parts[1]).when(n == 2, parts[0])
    ss = F.when(n == 3, parts[2]).when(n == 2, parts[1])
    hh, mm, ss = [F.when(x == "", F.lit("0")).otherwise(x) for x in (hh, mm, ss)]
    ok = hh.rlike(r"^\d+$") & mm.rlike(r"^\d+$") & ss.rlike(r"^\d+(\.\d+)?$")
    return (F.when(ok, hh.try_cast("long")), F.when(ok, mm.try_cast("long")),
            F.when(ok, ss.try_cast("decimal(20,9)")))


def duration_seconds(text) -> Column:
    """whole seconds (truncated) of a duration text, NULL when unparseable."""
    h, m, s = parse_duration_parts(text)
    return (h * 3600 + m * 60 + F.floor(s)).cast("int")


def duration_interval(text) -> Column:
    """the same duration as INTERVAL DAY TO SECOND."""
    h, m, s = parse_duration_parts(text)
    total = (h * 3600 + m * 60).cast("decimal(20,9)") + s
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), total.cast("decimal(18,6)"))


def is_time_like(c) -> Column:
    """'H:MM:SS' / 'HH:MM:SS' at the start of the cell (prefix match)."""
    return F.coalesce(_c(c).rlike(_TIME_LIKE), F.lit(False))


def placeholder_club(c) -> Column:
    """V9: '*' or '-' -> ''."""
    return F.when(_c(c).isin("*", "-"), F.lit("")).otherwise(_c(c))
