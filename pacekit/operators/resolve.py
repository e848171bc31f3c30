"""Fuzzy entity resolution: two passes of constrained name matching.

Semantics (the reference's):
  * names are reduced to a match key (F13); entities with >= 3 rows are frequent;
  * pass 1 compares frequent entities pairwise: same sex (null == null), no
    shared event, final = round(0.9 * token_sort_ratio + 0.1 * speed_score, 1) >= 95;
    canonical = the one with more rows (tie: alphabetically first); when a name
    is the "other" of several pairs, the last pair in (name_1, name_2) order wins;
  * corrections are applied once (single hop);
  * pass 2 maps rare entities to frequent ones of the same blocking key (F14):
    top 5 candidates by ratio (ties: candidate name), then ratio >= 85, same sex,
    final >= 95; the last accepted candidate wins (the lowest ratio).

Plan (no pair loop, no cross join): every accepted pair has ratio >= 94.39, i.e.
Indel distance <= k = floor(101 * T / 1800) (T = total length). Up to T = 53, k is 2 at most: two such strings are
equal after at most two deletions in all, so they are found by equality on the strings with letters left out
(one of each, or up to two of the longer one), which yields the pairs themselves and no other candidates,
however much text the names share. Longer candidates come from an inverted index over 3-grams, exactly: k edits destroy at most 3 k of a string's numbered 3-grams, so two such strings share
all but 3 k of them, and if each string's grams are ordered from rare to frequent, the first 3 k + c
of both have c in common. Only these go into the index, with their places (a shared gram moves by k places at
most), so it has some 0.4 rows a character; frequent grams, a common name half for one, are hardly ever in it.
Pairs that meet in c grams get the exact ratio. So do, without either, all pairs of a group of equal ``equi`` columns
that has few of them, as most blocks of pass 2 do. Because every candidate ranked above an
accepted one also has ratio >= 94.39, the top-5 rule of pass 2 restricted to
these candidates selects exactly the same matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import MAX_MASK_LEN, char_masks, max_indel, with_lcs
from ..functions.numeric import speed_step_score, weighted_score_x10
from ..functions.text import blocking_key, match_key, token_sort
from ..session import cut_lineage
from .joins import join_checked

FREQUENT_MIN = 3
THRESHOLD_X10 = 950   # final score 95.0
MIN_NAME_SCORE = 85.0
TOP_K = 5
GRAM = 3
SHORT = 53            # total length up to which two deletions decide
PART_KEYS = 5000      # strings a task takes apart into rests or grams
FEW_PAIRS = 8         # pairs a string up to which comparing all of a group costs less than taking its strings apart


def profiles(rows: DataFrame, name: str = "Nom_clean", sex: str = "Sexe", speed: str = "speed_kmh") -> DataFrame:
    """Per entity: row count, mode of sex (ties -> smallest, nulls ignored), mean speed.

    Two partial aggregations: (name, sex) then name -- a hot name costs one
    row per map task, never a whole group in one task.
    """
    by_sex = rows.groupBy(name, sex).agg(F.count(F.lit(1)).alias("_n"), F.sum(speed).alias("_s"),
                                         F.count(speed).alias("_c"))
    sex_rank = F.struct(F.when(F.col(sex).isNull(), 1).otherwise(0), -F.col("_n"), F.col(sex))
    return (by_sex.groupBy(name).agg(
        F.sum("_n").cast("long").alias("n_races"),
        F.min_by(F.when(F.col(sex).isNotNull(), F.col(sex)), sex_rank).alias("sexe"),
        (F.sum("_s") / F.sum("_c")).alias("mean_speed")))


def _numbered_grams(key: Column) -> Column:
    """A string's 3-grams, both ends padded: ``g`` the gram with its number among its equals, ``p`` and ``q`` the
    first and the last place of its equals."""
    pad = "\u0001" * (GRAM - 1)
    padded, n = F.concat(F.lit(pad), key, F.lit(pad)), F.length(key) + GRAM - 1
    grams = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(padded, i, GRAM))
    def rows(all_):
        return F.transform(all_, lambda g, i: F.struct(
            F.concat(g, F.size(F.filter(F.slice(all_, F.lit(1), i), lambda x: x == g)).cast("string")).alias("g"),
            F.array_position(all_, g).cast("int").alias("p"), (n + 1 - F.array_position(F.reverse(all_), g)).cast("int").alias("q")))
    return F.transform(F.array(grams), rows)[0]


def _index(keys: DataFrame, key: str, equi: list[str], shared: int) -> DataFrame:
    """The index: of every key its ``3 k + shared`` rarest grams, k being the largest distance to any partner."""
    length, row = F.length(key), [*keys.columns]
    grams = keys.select(*row, F.explode(_numbered_grams(F.col(key))).alias("_t")).select(*row, "_t.*")
    # as many rows as there are different grams: a few ten thousand over the match keys' letters
    rarity = grams.groupBy("g").agg(F.count(F.lit(1)).alias("_n"))
    # ly - lx <= 101 (lx + ly) / 1800 bounds the partner's length, hence k by 202 lx / 1699
    most = GRAM * F.floor(length * 202 / 1699)
    ordered = (grams.join(rarity.hint("merge"), "g").groupBy(*row).agg(F.sort_array(F.collect_list(F.struct("_n", "g", "p", "q"))).alias("_gs")))
    wanted = F.least(F.lit(shared), F.size("_gs") - most)
    return (ordered.withColumn("_c", wanted).withColumn("_t", F.explode(F.slice("_gs", F.lit(1), most + F.col("_c"))))
                   .select(*row, F.col("_c").alias("c"), "_t.g", "_t.p", "_t.q"))


def _less_one(s: Column, start=1) -> Column:
    """``s`` without one letter, from place ``start`` on: a string for each."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: (i >= start) & (F.length(s) > 0))
    return F.transform(places, lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)))


def _less_two(s: Column) -> Column:
    """``s`` without any two letters."""
    n = F.length(s)
    places = F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: n > 1)
    return F.flatten(F.transform(places, lambda i: _less_one(F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)), i)))


def _both_orders(pairs: DataFrame, equi: list[str]) -> DataFrame:
    """Each pair (l_key, r_key) and its mirror image."""
    def pair(left, right):
        return F.struct(F.col(left).alias("l_key"), F.col(right).alias("r_key"))
    return pairs.select(*equi, F.inline(F.array(pair("l_key", "r_key"), pair("r_key", "l_key"))), "lcs")


def _short_pairs(left: DataFrame, right: DataFrame, key: str, equi: list[str]) -> DataFrame:
    """The different strings of a total length up to ``SHORT`` within the distance, with their LCS: joins on equal rests.

    Spark takes an exploded side for as small as its strings, some 200 times too small, and would collect it on
    the driver to send it out: merge joins deal both sides.
    """
    itself = left is right
    def rests(df: DataFrame, side: str, made: Column) -> DataFrame:
        return df.select(*equi, F.col(key).alias(side), F.explode(F.array_distinct(made)).alias("_rest"))
    s, n = F.col(key), F.length(key)
    whole = lambda df, side: df.select(*equi, F.col(key).alias(side), F.col(key).alias("_rest"))                          # noqa: E731
    # of T letters in all, 18 allow for one and 36 for two deletions
    some = lambda df, side: rests(df.where(2 * n - 1 >= 18), side, F.concat(_less_one(s), F.when(2 * n - 2 >= 36, _less_two(s)).otherwise(F.array().cast("array<string>"))))
    one = lambda df, side: rests(df.where(2 * n >= 36), side, _less_one(s))                                               # noqa: E731
    on = [*equi, "_rest"]
    found = one(left, "l_key").join(one(right, "r_key").hint("merge"), on).where("l_key < r_key" if itself else "l_key <> r_key")
    found = found.unionByName(whole(left, "l_key").join(some(right, "r_key").hint("merge"), on))
    if not itself:
        found = found.unionByName(some(left, "l_key").join(whole(right, "r_key").hint("merge"), on))
    size = F.length("l_key") + F.length("r_key")
    apart = F.when(F.length("l_key") == F.length("r_key"), 2).otherwise(F.abs(F.length("l_key") - F.length("r_key")))
    found = (found.where((size <= SHORT) & (apart <= max_indel(size))).select(*equi, "l_key", "r_key").distinct()
                  .withColumn("lcs", ((size - apart) / 2).cast("int")))
    return _both_orders(found, equi) if itself else found


def _mark_small_groups(keys: DataFrame, equi: list[str]) -> DataFrame:
    """``_few``: whether the two sides of the string's group make up to ``FEW_PAIRS`` pairs a string."""
    left, right = (F.count_if(F.col("_side").bitwiseAND(side) > 0) for side in (1, 2))
    small = keys.groupBy(*equi).agg(left.alias("_l"), right.alias("_r")).where(F.col("_l") * F.col("_r") <= FEW_PAIRS * (F.col("_l") + F.col("_r")))
    marked = keys.drop("_few").join(small.select(*equi, F.lit(True).alias("_few")).hint("merge"), equi, "left")
    return marked.withColumn("_few", F.coalesce("_few", F.lit(False)))


def similar_pairs(left: DataFrame, right: DataFrame, key: str, equi: list[str] | None = None,
                  max_len: int | None = None, shared: int = 3) -> DataFrame:
    """All (l, r) with Indel distance(l.key, r.key) <= floor(101 * T / 1800), exactly.

    ``left``/``right`` need column ``key`` (the token-sorted string) plus the
    ``equi`` columns, which must also be equal.  Output: l_<key>, r_<key>, lcs.
    Empty strings have no partner. ``shared`` is the number of grams that candidates must meet in
    (fewer for strings too short for it); it decides how many candidates are verified, not the result.
    """
    equi, itself = equi or [], left is right
    def keys_of(df, side):
        return df.select(key, *equi).where(F.length(key) > 0).distinct().withColumn("_side", F.lit(side))
    both = keys_of(left, 1) if itself else keys_of(left, 1).unionByName(keys_of(right, 2))
    all_keys = both.groupBy(key, *equi).agg(F.bit_or("_side").alias("_side")).withColumn("_few", F.lit(False))
    if equi and not itself:
        all_keys = _mark_small_groups(all_keys, equi)
    all_keys = cut_lineage(all_keys)
    keys = all_keys.where("NOT _few").drop("_few")
    # one small aggregate: decides the UDF branch and the parts
    n_keys, longest = all_keys.agg(F.count_if(~F.col("_few")), F.max(F.length(key))).first()
    max_len = max_len or longest or 1
    if n_keys > PART_KEYS:                                           # parts by size would hold far too many rests
        keys = keys.repartition(-(-n_keys // PART_KEYS), key)
    short = keys.where(2 * F.length(key) - 2 <= SHORT)
    ours, theirs = (short, short) if itself else (short.where("_side & 1 > 0"), short.where("_side & 2 > 0"))
    close = _short_pairs(ours, theirs, key, equi)
    # a string of l letters has no partner of more than 1901 l / 1699
    index = cut_lineage(_index(keys.where(F.length(key) * 3600 / 1699 > SHORT), key, equi, shared))             # read twice by the join
    a = index.select("g", *equi, F.col(key).alias("l_key"), F.col("_side").alias("_sl"), F.col("c").alias("_cl"), F.col("p").alias("_pl"), F.col("q").alias("_ql"))
    b = index.select("g", *equi, F.col(key).alias("r_key"), F.col("_side").alias("_sr"), F.col("c").alias("_cr"), F.col("p").alias("_pr"), F.col("q").alias("_qr"))
    total, k = F.length("l_key") + F.length("r_key"), max_indel(F.length("l_key") + F.length("r_key"))
    sides = F.col("l_key") < F.col("r_key") if itself else F.col("_sl").bitwiseAND(1) + F.col("_sr").bitwiseAND(2) == 3
    met = a.join(b.hint("merge"), ["g", *equi]).where(sides & (total > SHORT) & (F.col("l_key") != F.col("r_key")) & (F.abs(F.length("l_key") - F.length("r_key")) <= k)
                                       & (F.col("_pl") - k <= F.col("_qr")) & (F.col("_pr") - k <= F.col("_ql")))
    cand = (met.groupBy(*equi, "l_key", "r_key").agg(F.count(F.lit(1)).alias("_m"), F.min(F.least("_cl", "_cr")).alias("_need"))
               .where(F.col("_m") >= F.col("_need")).select(*equi, "l_key", "r_key"))
    if equi and not itself:
        ours, theirs = (all_keys.where(F.col("_few") & (F.col("_side").bitwiseAND(side) > 0)).select(*equi, F.col(key).alias(name))
                        for side, name in ((1, "l_key"), (2, "r_key")))
        cand = cand.unionByName(ours.join(theirs.hint("merge"), equi).where((F.col("l_key") != F.col("r_key")) & (F.abs(F.length("l_key") - F.length("r_key")) <= k)))
    shorter = F.length("l_key") <= F.length("r_key")
    cand = (cand.withColumn("_xstr", F.when(shorter, F.col("l_key")).otherwise(F.col("r_key")))
                .withColumn("_ystr", F.when(shorter, F.col("r_key")).otherwise(F.col("l_key"))).withColumn("_xlen", F.length("_xstr")))
    same = (all_keys if itself else all_keys.where("_side = 3")).select(*equi, F.col(key).alias("l_key"), F.col(key).alias("r_key"), F.length(key).alias("lcs"))
    other = cut_lineage(cand)                                        # the character masks are then made once a string
    masks = other.select("_xstr").distinct().withColumn("_xmask", char_masks("_xstr"))
    verified = with_lcs(other.join(cut_lineage(masks).hint("merge"), "_xstr"), "_xstr", "_xlen", "_xmask", "_ystr", may_be_long=max_len > MAX_MASK_LEN)
    found = verified.where(total - 2 * F.col("lcs") <= max_indel(total)).select(*equi, "l_key", "r_key", "lcs")
    if itself:
        found = _both_orders(found, equi)
    return found.unionByName(close).unionByName(same)


def _ratio(lcs, total):
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs / total)


def frequent_pairs(prof: DataFrame, events: DataFrame, name: str = "Nom_clean") -> DataFrame:
    """Accepted pass-1 pairs (name_1 < name_2) with scores and the canonical name."""
    p = prof.withColumn("_ts", token_sort(name)).withColumn("_sx", F.coalesce(F.col("sexe"), F.lit("\u0000")))
    keyed = p.select("_ts", "_sx")
    sim = similar_pairs(keyed, keyed, "_ts", ["_sx"])  # same object: self-similarity mode
    a = p.select(F.col(name).alias("name_1"), F.col("_ts").alias("l_key"), "_sx",
                 F.col("n_races").alias("races_1"), F.col("mean_speed").alias("speed_1"))
    b = p.select(F.col(name).alias("name_2"), F.col("_ts").alias("r_key"), "_sx",
                 F.col("n_races").alias("races_2"), F.col("mean_speed").alias("speed_2"))
    # (l_key, r_key) comes in both orders, identical keys included (names sharing a sorted key)
    # merge joins: what Spark expects of these sides are the bytes of a compressed file, far less than they hold
    pairs = sim.join(a.hint("merge"), ["l_key", "_sx"]).join(b.hint("merge"), ["r_key", "_sx"]).where(F.col("name_1") < F.col("name_2"))
    pairs = pairs.where(F.abs(F.col("speed_1") - F.col("speed_2")) < 2)   # speed score 0 cannot reach 95
    total = F.length("l_key") + F.length("r_key")
    sp = speed_step_score(F.abs(F.col("speed_1") - F.col("speed_2")))
    pairs = (pairs.withColumn("name_score", _ratio(F.col("lcs"), total))
                  .withColumn("speed_score", sp)
                  .withColumn("final_x10", weighted_score_x10(2 * F.col("lcs"), total, sp))
                  .where(F.col("final_x10") >= THRESHOLD_X10))
    # no shared event: anti join against pairs that co-occur in one event
    ev = events.select(F.col(name).alias("_n"), F.col("_event")).distinct()
    shared = (pairs.select("name_1", "name_2")
                   .join(ev.withColumnRenamed("_n", "name_1").hint("merge"), "name_1")
                   .join(ev.withColumnRenamed("_n", "name_2").hint("merge"), ["name_2", "_event"])
                   .select("name_1", "name_2").distinct())
    pairs = pairs.join(shared.hint("merge"), ["name_1", "name_2"], "left_anti")
    first_wins = F.col("races_1") >= F.col("races_2")
    return pairs.select(
        "name_1", "name_2", "races_1", "races_2", "name_score", "speed_score",
        (F.col("final_x10") / 10.0).alias("final_score"),
        F.when(first_wins, F.col("name_1")).otherwise(F.col("name_2")).alias("canonical"),
        F.when(first_wins, F.col("name_2")).otherwise(F.col("name_1")).alias("other"))


def frequent_corrections(pairs: DataFrame) -> DataFrame:
    """Dict semantics -- per ``other`` the pair that comes last in (name_1, name_2) order."""
    return pairs.groupBy("other").agg(F.max_by("canonical", F.struct("name_1", "name_2")).alias("canonical"))


def rare_matches(rare: DataFrame, freq: DataFrame, name: str = "Nom_clean", keep: str = "last") -> DataFrame:
    """Accepted rare -> frequent matches, ``chosen`` marks the one applied.

    keep='last' reproduces the reference (lowest accepted ratio wins, ties -> the
    alphabetically last candidate); keep='best' takes the highest instead.
    """
    r = rare.withColumn("_ts", token_sort(name)).withColumn("_blk", blocking_key(name))
    f = freq.withColumn("_ts", token_sort(name)).withColumn("_blk", blocking_key(name))
    sim = similar_pairs(r.select("_ts", "_blk"), f.select("_ts", "_blk"), "_ts", ["_blk"])
    a = r.select(F.col(name).alias("rare_name"), F.col("_ts").alias("l_key"), "_blk",
                 F.col("sexe").alias("rare_sex"), F.col("mean_speed").alias("rare_speed"))
    b = f.select(F.col(name).alias("freq_name"), F.col("_ts").alias("r_key"), "_blk",
                 F.col("sexe").alias("freq_sex"), F.col("mean_speed").alias("freq_speed"))
    cand = sim.join(a.hint("merge"), ["l_key", "_blk"]).join(b.hint("merge"), ["r_key", "_blk"])
    total = F.length("l_key") + F.length("r_key")
    cand = cand.withColumn("name_score", _ratio(F.col("lcs"), total)).withColumn("_total", total)
    w = Window.partitionBy("rare_name").orderBy(F.desc("name_score"), F.col("freq_name"))
    cand = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP_K)
    sp = speed_step_score(F.abs(F.col("rare_speed") - F.col("freq_speed")))
    cand = (cand.where((F.col("name_score") >= MIN_NAME_SCORE) & F.col("rare_sex").eqNullSafe(F.col("freq_sex")))
                .withColumn("speed_score", sp)
                .withColumn("final_x10", weighted_score_x10(2 * F.col("lcs"), F.col("_total"), sp))
                .where(F.col("final_x10") >= THRESHOLD_X10))
    order = F.struct(-F.col("name_score"), F.col("freq_name")) if keep == "last" else \
        F.struct(F.col("name_score"), -F.col("rank"))
    pick = cand.groupBy("rare_name").agg(F.max_by("freq_name", order).alias("_pick"))
    return (cand.join(pick, "rare_name")
                .select("rare_name", "freq_name", "rank", "name_score", "speed_score",
                        (F.col("final_x10") / 10.0).alias("final_score"),
                        (F.col("freq_name") == F.col("_pick")).alias("chosen")))


def apply_corrections(rows: DataFrame, corr: DataFrame, name: str = "Nom_clean",
                      other: str = "other", canonical: str = "canonical") -> DataFrame:
    """Single-hop replacement (A->B, B->C leaves A at B)."""
    c = corr.select(F.col(other).alias("_o"), F.col(canonical).alias("_c"))
    j = join_checked(rows, c, F.col(name) == F.col("_o"), "left")
    return j.withColumn(name, F.coalesce(F.col("_c"), F.col(name))).drop("_o", "_c")


def resolve_names(rows: DataFrame, raw_name: str = "Nom", sex: str = "Sexe", speed: str = "speed_kmh",
                  event: str = "racekey", keep: str = "last") -> dict[str, DataFrame]:
    """E1-E7 end to end.  Returns rows (with Nom_clean) and the intermediate tables."""
    df = rows.withColumn("Nom_clean", match_key(raw_name)).withColumn("_event", F.col(event))
    counts = df.groupBy("Nom_clean").agg(F.count(F.lit(1)).alias("_cnt"))
    freq_names = counts.where(F.col("_cnt") >= FREQUENT_MIN).select("Nom_clean")
    freq_rows = df.join(freq_names.hint("merge"), "Nom_clean", "left_semi")
    prof1 = cut_lineage(profiles(freq_rows, "Nom_clean", sex, speed))     # read three times
    pairs = frequent_pairs(prof1, freq_rows.select("Nom_clean", "_event"))
    pairs = cut_lineage(pairs)            # small; fixes pass 1 for everything below
    corr1 = frequent_corrections(pairs)
    df1 = apply_corrections(df, corr1)
    prof2 = cut_lineage(profiles(df1, "Nom_clean", sex, speed))           # read four times
    freq2 = prof2.where(F.col("n_races") >= FREQUENT_MIN)
    rare2 = prof2.where(F.col("n_races") < FREQUENT_MIN)
    matches = cut_lineage(rare_matches(rare2, freq2, keep=keep))
    corr2 = matches.where("chosen").select(F.col("rare_name").alias("other"), F.col("freq_name").alias("canonical"))
    df2 = apply_corrections(df1, corr2).drop("_event")
    return {"rows": df2, "pairs": pairs, "pass1": corr1, "matches": matches, "pass2": corr2,
            "profiles": prof1}


def correction_report(rows: DataFrame, pass1: DataFrame, pass2: DataFrame, raw_name: str = "Nom") -> DataFrame:
    """Corrections applied, distinct names before / after, reduction."""
    before = rows.agg(F.countDistinct(raw_name).alias("unique_before"))
    after = rows.agg(F.countDistinct("Nom_clean").alias("unique_after"))
    n = pass1.agg(F.count(F.lit(1)).alias("_a")).crossJoin(pass2.agg(F.count(F.lit(1)).alias("_b")))
    return (n.crossJoin(before).crossJoin(after)
             .select((F.col("_a") + F.col("_b")).alias("corrections"), "unique_before", "unique_after",
                     (F.col("unique_before") - F.col("unique_after")).alias("reduction")))
