"""Record cleaning: category harmonisation, overrides, type checks, drops."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import INVALID_TIMES, duration_parts_staged
from .dedup import keep_first

# Raw category -> harmonised code (anything else, null included, -> 'XXX').
CATEGORY_MAP = {
    "": "XXX", "#N/A": "XXX", "#REF!": "XXX", "xxx": "XXX", "XXX": "XXX", "0": "XXX",
    "A1": "A1", "AI1": "A1", "V1F": "A1",
    "A2": "A2", "AI2": "A2", "V2F": "A2",
    "A3": "A3", "AI3": "A3", "V3F": "A3",
    "A4": "A4", "AI4": "A4", "V4F": "A4",
    "A5": "A5", "AI5": "A5", "V45": "A5",
    "SH": "SH", "H": "SH", "SEH": "SH", "SEN": "SH", "DISH": "SH", "SE": "SH",
    "JUH": "ESH", "JH": "ESH", "EH": "ESH", "ESH": "ESH", "ESP": "ESH", "GAR": "ESH",
    "DA": "SD", "DAM": "SD", "SD": "SD", "F": "SD", "SEF": "SD", "DISF": "SD",
    "JUF": "ESF", "JF": "ESF", "EF": "ESF", "ESF": "ESF", "FIL": "ESF", "ED": "ESF",
    "V1": "V1", "VE1": "V1", "V1H": "V1",
    "V2": "V2", "VE2": "V2", "V2H": "V2",
    "V3": "V3", "VE3": "V3", "V3H": "V3",
    "V4": "V4", "VE4": "V4", "V4H": "V4",
    "V5": "V5", "VE5": "V5", "V5H": "V5",
}
UNKNOWN_CATEGORY = "XXX"

POS_CAT = "Position Catégorie"


def category_table(spark: SparkSession, mapping: dict[str, str] = CATEGORY_MAP) -> DataFrame:
    """The mapping as a two-column table (raw, code)."""
    return spark.createDataFrame(sorted(mapping.items()), "raw string, code string")


def harmonise_category(df: DataFrame, col: str = "Categorie", out: str = "categorie_cleaned",
                       mapping: dict[str, str] = CATEGORY_MAP) -> DataFrame:
    """Map raw categories to codes, default 'XXX'.

    The mapping is a literal ``map`` column (60 entries), evaluated inside the
    generated code: no join, no shuffle.
    """
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out, F.coalesce(F.element_at(m, F.col(col)), F.lit(UNKNOWN_CATEGORY)))


def reset_rank_for_unknown(df: DataFrame, cat: str = "categorie_cleaned", rank: str = POS_CAT) -> DataFrame:
    """Rank in category := '0' when the category is unknown."""
    return df.withColumn(rank, F.when(F.col(cat) == UNKNOWN_CATEGORY, F.lit("0")).otherwise(F.col(rank)))


def cast_ints(df: DataFrame, cols=("Position", POS_CAT), strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Text -> INT.  Returns (good rows, quarantined rows with a bad value).

    ``strict=True`` uses ANSI ``cast`` so the first bad value fails the job, as the reference does.
    """
    if strict:
        return df.select(*[F.col(c).cast("int").alias(c) if c in cols else F.col(c) for c in df.columns]), None
    casted = df.select(*[F.col(c).try_cast("int").alias(c) if c in cols else F.col(c) for c in df.columns],
                       *[F.col(c).alias(f"_raw_{i}") for i, c in enumerate(cols)])
    bad = F.lit(False)
    for i, c in enumerate(cols):
        bad = bad | (F.col(c).isNull() & F.col(f"_raw_{i}").isNotNull())
    raws = [f"_raw_{i}" for i in range(len(cols))]
    return casted.where(~bad).drop(*raws), casted.where(bad)


def parse_times(df: DataFrame, col: str = "Temps") -> DataFrame:
    """F11 + P9: temps_clean (interval), temps_sec (int); rows without a valid time are dropped.

    The text is split once into staged columns so the projection stays small
    enough for whole-stage code generation.
    """
    h, m, s = duration_parts_staged(col)
    staged = df.withColumn("_tparts", F.split(F.when(~F.trim(F.col(col)).isin(*INVALID_TIMES),
                                                      F.regexp_replace(F.trim(F.col(col)), " ", "")), ":"))
    staged = staged.withColumn("_h", h).withColumn("_m", m).withColumn("_s", s)
    whole = (F.col("_h") * 3600 + F.col("_m") * 60).cast("decimal(20,9)") + F.col("_s")
    return (staged.where(F.col("_s").isNotNull())
                  .withColumn("temps_clean", F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                whole.cast("decimal(18,6)")))
                  .withColumn("temps_sec", F.floor(whole).cast("int"))
                  .drop("_tparts", "_h", "_m", "_s"))


@dataclass(frozen=True)
class Override:
    """Set ``set_col := set_value`` where ``match_col == match_value``
    (and, when given, ``cond_col`` is not equal to ``cond_not``; null counts as not equal)."""
    match_col: str
    match_value: object
    set_col: str
    set_value: object
    cond_col: str | None = None
    cond_not: object = None


def apply_overrides(df: DataFrame, rules: list[Override]) -> DataFrame:
    """Value overrides as one projection of ``when`` chains.

    Rules are applied in order on the original values (later rules win on conflict).
    """
    sets: dict[str, Column] = {}
    for r in rules:
        cond = F.col(r.match_col) == F.lit(r.match_value)
        if r.cond_col is not None:
            cond = cond & ~F.col(r.cond_col).eqNullSafe(F.lit(r.cond_not))
        base = sets.get(r.set_col, F.col(r.set_col))
        sets[r.set_col] = F.when(cond, F.lit(r.set_value).cast(df.schema[r.set_col].dataType)).otherwise(base)
    return df.select(*[sets[c].alias(c) if c in sets else F.col(c) for c in df.columns])


def drop_bad_names(df: DataFrame, col: str = "Nom", bad=("#N/A",)) -> DataFrame:
    """Drop names starting with a digit and literal bad values; null names are kept."""
    starts_digit = F.coalesce(F.col(col).rlike(r"^\d"), F.lit(False))
    return df.where(~starts_digit & ~F.coalesce(F.col(col).isin(*bad), F.lit(False)))


def race_key(name, date, distance) -> Column:
    """lower(trim(name)) _ date _ distance."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat_ws("_", F.lower(F.trim(c(name))), F.coalesce(F.date_format(c(date), "yyyy-MM-dd"), F.lit("NaT")),
                       F.trim(c(distance).cast("string")))


def dedup_results(df: DataFrame, keys=("racekey", "Nom"), order=("source_file", "Position")) -> DataFrame:
    """One row per (racekey, name); first by file name then position (deterministic)."""
    return keep_first(df, list(keys), list(order))


def clean_results(df: DataFrame, overrides: list[Override] | None = None, strict: bool = False) -> DataFrame:
    """The cleaning step in the reference's order, without name resolution."""
    df = harmonise_category(df)
    df = reset_rank_for_unknown(df)
    df, _bad = cast_ints(df, strict=strict)
    df = parse_times(df)
    value_rules = [r for r in (overrides or []) if r.match_col != "Nom"]
    name_rules = [r for r in (overrides or []) if r.match_col == "Nom"]
    if value_rules:
        df = apply_overrides(df, value_rules)
    df = drop_bad_names(df)
    if name_rules:
        df = apply_overrides(df, name_rules)
    return df
