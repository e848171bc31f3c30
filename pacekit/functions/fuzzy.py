"""Token-sort ratio (normalised Indel similarity) as native column expressions.

ratio(a, b) = 100 * 2 * LCS(a', b') / (len a' + len b') with a', b' the
whitespace tokens sorted and joined by one space (no case folding).

LCS uses the bit-parallel recurrence (Allison-Dix / Hyyro) over BIGINT
masks: with PM[c] the bit set of positions of character c in the shorter
string x (|x| <= 62 so no signed overflow),

    V := all ones;  for c in y:  U := V & PM[c];  V := ((V + U) | (V - U)) & ALL
    LCS = popcount(~V & ALL)

``char_masks`` builds PM once per distinct string (a MAP<STRING,BIGINT>), so
a pair costs |y| map lookups.  Pairs where both strings exceed 62 characters
go through a small pandas UDF with the same recurrence on Python's whole numbers.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

MAX_MASK_LEN = 62


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pow2(i) -> Column:
    """2**i as BIGINT for a column i in 0..62 (exact through double)."""
    return F.pow(F.lit(2.0), i).cast("long")


def char_masks(s) -> Column:
    """MAP char -> bitmask of its positions in ``s`` (strings up to 62 characters)."""
    s = _c(s)
    chars = F.split(s, "")
    n = F.length(s)
    idx = F.sequence(F.lit(0), n - 1)
    def mask(ch):
        return F.aggregate(idx, F.lit(0).cast("long"),
                           lambda m, i: m.bitwiseOR(F.when(F.substring(s, i + 1, 1) == ch,
                                                   _pow2(i)).otherwise(F.lit(0).cast("long"))))
    return F.when((n > 0) & (n <= MAX_MASK_LEN),
                  F.map_from_arrays(F.array_distinct(chars),
                                    F.transform(F.array_distinct(chars), mask)))


def lcs_bitparallel(x_len, x_masks, y) -> Column:
    """LCS length of x (given by its length and ``char_masks``) and string y."""
    all_ones = _pow2(_c(x_len)) - 1
    v = F.aggregate(F.split(_c(y), ""), all_ones,
                    lambda v, ch: F.aggregate(
                        F.array(v.bitwiseAND(F.coalesce(F.element_at(_c(x_masks), ch), F.lit(0).cast("long")))),
                        F.lit(0).cast("long"),
                        lambda _acc, u: (v + u).bitwiseOR(v - u).bitwiseAND(all_ones)))
    return F.bit_count(F.bitwise_not(v).bitwiseAND(all_ones)).cast("int")


def _lcs(x: str, y: str) -> int:
    """The same recurrence on whole numbers of any size: |y| steps a pair."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(x):
        masks[ch] = masks.get(ch, 0) | 1 << i
    v = ones = (1 << len(x)) - 1
    for ch in y:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & ones
    return len(x) - v.bit_count()


@F.pandas_udf(IntegerType())
def lcs_long(a: pd.Series, b: pd.Series) -> pd.Series:
    """LCS of pairs whose shorter string exceeds 62 characters."""
    return pd.Series([_lcs(x, y) for x, y in zip(a, b)], dtype="int32")


def with_lcs(pairs: DataFrame, x: str, x_len: str, x_masks: str, y: str, out: str = "lcs",
             may_be_long: bool = True) -> DataFrame:
    """Add the LCS of columns ``x`` and ``y``; native when |x| <= 62, pandas UDF otherwise.

    ``may_be_long=False`` (the caller checked that no string exceeds 62
    characters) skips the Python branch entirely.
    """
    if not may_be_long:
        return pairs.withColumn(out, lcs_bitparallel(x_len, x_masks, y))
    short = pairs.where(F.col(x_len) <= MAX_MASK_LEN)
    long_ = pairs.where(F.col(x_len) > MAX_MASK_LEN)
    return (short.withColumn(out, lcs_bitparallel(x_len, x_masks, y))
                 .unionByName(long_.withColumn(out, lcs_long(F.col(x), F.col(y)))))


def max_indel(total_len) -> Column:
    """Largest Indel distance that can still reach a final score of 95 (speed score 100):
    ratio >= 84.95 / 0.9  <=>  d <= floor(101 * T / 1800) with T = |a| + |b|."""
    return F.floor(F.lit(101) * _c(total_len) / 1800).cast("int")


def max_indel_py(total_len: int) -> int:
    return (101 * total_len) // 1800
