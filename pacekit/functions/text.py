"""Name keys and text normalisation as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _accent_table() -> tuple[str, str]:
    """Precomposed letter -> base letter, generated from Unicode data (Latin blocks)."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


_ACC_SRC, _ACC_DST = _accent_table()


def strip_accents(c) -> Column:
    """NFD + drop combining marks: precomposed letters via ``translate``, loose marks via regex."""
    return F.regexp_replace(F.translate(_c(c), _ACC_SRC, _ACC_DST), r"\p{Mn}", "")


def python_title(c) -> Column:
    """Python ``str.title``: upper after any non-letter, lower elsewhere ('jean-pierre' -> 'Jean-Pierre')."""
    runs = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                              F.lower(F.substring(w, 2, 1 << 20)))), "")


def collapse_spaces(c) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(c), r"\s+", " "), r"^ | $", "")


def normalize_name(c) -> Column:
    """collapse whitespace, trim, title case, strip accents."""
    return strip_accents(python_title(collapse_spaces(c)))


def normalize_course_name(c) -> Column:
    """drop 20xx years, then F4."""
    return normalize_name(F.regexp_replace(_c(c), r"\b20\d{2}\b", ""))


_PY_SPACE = r"[\s\x1c-\x1f]"


def ascii_lower(c) -> Column:
    """drop non-ASCII characters, lower, strip; null -> ''."""
    s = F.lower(F.regexp_replace(_c(c), r"[^\x00-\x7F]", ""))
    s = F.regexp_replace(s, rf"^{_PY_SPACE}+|{_PY_SPACE}+$", "")
    return F.coalesce(s, F.lit(""))


def match_key(c) -> Column:
    """upper, every non A-Z (except whitespace) -> space, collapse spaces, trim; null -> ''."""
    s = F.regexp_replace(F.upper(_c(c)), r"[^A-Z\s]", " ")
    s = F.regexp_replace(s, r"\s+", " ")
    return F.coalesce(F.trim(s), F.lit(""))


def token_sort(c) -> Column:
    """Tokens (split on whitespace) sorted and joined by one space."""
    toks = F.filter(F.split(_c(c), r"\s+"), lambda t: t != "")
    return F.array_join(F.array_sort(toks), " ")


def blocking_key(c) -> Column:
    """sorted tokens, first 3 characters of each, concatenated."""
    toks = F.filter(F.split(_c(c), r"\s+"), lambda t: t != "")
    return F.array_join(F.transform(F.array_sort(toks), lambda t: F.substring(t, 1, 3)), "")
