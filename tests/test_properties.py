"""Property tests: leakage, fuzzy score, candidate plan vs brute force, z-scores, partitioning."""

import random
import string

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pacekit.functions.fuzzy import char_masks, lcs_bitparallel
from pacekit.operators import resolve as RV
from pacekit.operators.history import add_group_zscore, add_history
from pacekit.operators.ranking import group_median, group_row_number
from pacekit.sources import adapters
from conftest import SF_SMALL


def lcs_dp(a, b):
    prev = [0] * (len(a) + 1)
    for ch in b:
        cur = [0]
        for i, x in enumerate(a, 1):
            cur.append(prev[i - 1] + 1 if x == ch else max(prev[i], cur[-1]))
        prev = cur
    return prev[-1]


@settings(max_examples=1, deadline=None)
@given(st.just(0))
def test_lcs_bitparallel_matches_dp(spark, _):
    rnd = random.Random(7)
    pairs = []
    for _ in range(300):
        a = "".join(rnd.choice("ABCDE ") for _ in range(rnd.randint(1, 30)))
        b = "".join(rnd.choice("ABCDE ") for _ in range(rnd.randint(0, 40)))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", lcs_bitparallel(F.length("a"), char_masks("a"), F.col("b")).alias("l")).collect()
    for r in got:
        assert r.l == lcs_dp(r.a, r.b), (r.a, r.b)


def test_history_has_no_leakage(spark):
    r = adapters.results(spark, SF_SMALL, with_positions=False)
    runner = r.groupBy("runner_id").count().orderBy(F.desc("count")).first()["runner_id"]
    last = r.where(F.col("runner_id") == runner).orderBy(F.desc("date"), F.desc("race_id")).first()
    changed = r.withColumn("speed_kmh", F.when(F.col("result_id") == last["result_id"], F.lit(99.0))
                           .otherwise(F.col("speed_kmh")))
    cols = ["result_id", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "recent_speed_roll3"]
    def feats(df):
        h = add_history(add_group_zscore(df, median=False))
        return {row.result_id: tuple(row)[1:] for row in
                h.where((F.col("runner_id") == runner) & (F.col("result_id") != last["result_id"])).select(*cols).collect()}
    a, b = feats(r), feats(changed)
    assert a.keys() == b.keys()
    for k in a:   # floating merge order may differ with the range boundaries: compare to 1e-9
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None) and (x is None or abs(x - y) <= 1e-9 * max(1.0, abs(x)))


def test_zscore_per_race_is_standardised(spark):
    r = adapters.results(spark, SF_SMALL, with_positions=False)
    z = add_group_zscore(r, median=False).groupBy("race_id").agg(F.avg("speed_z_race").alias("m"),
                                                                F.stddev_samp("speed_z_race").alias("s"))
    for row in z.where(F.col("s").isNotNull()).collect():
        assert abs(row.m) < 1e-9 and abs(row.s - 1) < 1e-9


def test_rank_and_median_match_windows(spark):
    rnd = random.Random(3)
    # one hot group holding most rows, plus small groups and ties
    rows = [(0 if i < 600 else rnd.randint(1, 20), float(rnd.randint(0, 50)), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, v double, id int").repartition(7)
    from pyspark.sql import Window
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    got = group_row_number(df, ["g"], ["v", "id"], "rn")
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.select("g", "v", "id", "rn").collect()))
    med_want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    med_got = {r.g: r.median for r in group_median(df, ["g"], "v").collect()}
    assert med_want == med_got


def test_candidate_plan_equals_brute_force(spark):
    rnd = random.Random(11)
    base = ["JEAN DUPONT", "MARIE CURIE", "ABDULLAHI MOHAMED", "ALEXANDRE DE LA FONTAINE", "LI NA"]
    names = set(base)
    for b in base:
        names.add(" ".join(reversed(b.split())))
        for _ in range(4):
            s = list(b)
            k = rnd.randrange(len(s))
            op = rnd.choice("dis")
            if op == "d":
                del s[k]
            elif op == "i":
                s.insert(k, rnd.choice(string.ascii_uppercase))
            else:
                s[k] = rnd.choice(string.ascii_uppercase)
            names.add("".join(s))
    names = sorted(n for n in names if n.strip())
    df = spark.createDataFrame([(RV_key,) for RV_key in names], "k string").select(RV.token_sort("k").alias("k"))
    got = {(r.l_key, r.r_key) for r in RV.similar_pairs(df, df, "k").collect() if r.l_key < r.r_key}
    keys = sorted({" ".join(sorted(n.split())) for n in names})
    want = set()
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            T = len(a) + len(b)
            if T - 2 * lcs_dp(a, b) <= (101 * T) // 1800:
                want.add((a, b))
    assert got == want


@pytest.mark.parametrize("shared", [3, 1, 6])
def test_candidates_are_complete_for_long_names(spark, shared):
    """Names of 5 to 80 characters with edits, against all pairs; for several numbers of shared grams."""
    rng = random.Random(shared)
    names = set()
    while len(names) < 140:
        base = "".join(rng.choice("ABCD E") for _ in range(rng.randint(5, 80)))
        names.add(base)
        for _ in range(2):
            t = list(base)
            for _ in range(rng.randint(1, 5)):
                at = rng.randrange(len(t) + 1)
                if rng.random() < 0.6:
                    t.insert(at, rng.choice("ABCDE"))
                elif at < len(t) > 3:
                    del t[at]
            names.add("".join(t))
    keys = sorted(n for n in names if n.strip())
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {(r.l_key, r.r_key) for r in RV.similar_pairs(df, df, "k", shared=shared).collect() if r.l_key < r.r_key}
    want = {(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
            if abs(len(a) - len(b)) <= (101 * (len(a) + len(b))) // 1800
            and len(a) + len(b) - 2 * lcs_dp(a, b) <= (101 * (len(a) + len(b))) // 1800}
    assert got == want and any(len(a) > 62 and len(b) > 62 for a, b in want)


def test_null_groups_keep_their_rows(spark):
    from pacekit.operators import history as H
    from pacekit.operators import ranking as RK
    rows = [(1, None, None, 5.0), (2, None, "x", 7.0), (3, 10, None, 9.0), (4, 10, "x", 9.0), (5, 10, "x", 12.0), (6, None, None, 6.0)]
    df = spark.createDataFrame(rows, "result_id long, race_id long, runner_id string, speed_kmh double")
    assert {r.result_id: r.rn for r in RK.group_row_number(df, ["race_id"], ["speed_kmh", "result_id"]).collect()} == {1: 1, 6: 2, 2: 3, 3: 1, 4: 2, 5: 3}
    assert {r.race_id: r.median for r in RK.group_median(df, ["race_id"], "speed_kmh").collect()} == {None: 6.0, 10: 9.0}
    z = H.add_group_zscore(df)
    assert z.count() == 6 and z.where("race_id IS NULL AND speed_z_race IS NOT NULL").count() == 3
    dated = z.withColumn("date", F.make_date(F.lit(2020), F.lit(1), F.col("result_id").cast("int")))
    a = {r.result_id: r.prior_race_count for r in H.add_history(dated, segmented=True).collect()}
    b = {r.result_id: r.prior_race_count for r in H.add_history(dated, segmented=False).collect()}
    assert a == b and len(a) == 6


def test_quantiles_of_tied_values(spark):
    """Few distinct values over many rows: the ranks come from counts, so ties cost nothing."""
    from pacekit.operators import ranking as RK
    rows = [("g", 1.0)] * 700 + [("g", 2.0)] * 300 + [("h", 4.0), ("h", 6.0)] + [(None, 3.0)] * 5
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q25, r.q50, r.q75) for r in RK.group_quantiles(df, ["k"], "v", [0.25, 0.5, 0.75]).collect()}
    assert got == {"g": (1.0, 1.0, 2.0), "h": (4.5, 5.0, 5.5), None: (3.0, 3.0, 3.0)}
    assert {r.k: r.median for r in RK.group_median(df, ["k"], "v").collect()} == {"g": 1.0, "h": 5.0, None: 3.0}


def test_hot_entity_with_many_segments(spark):
    """One runner over hundreds of range partitions: the carried state is that of one window."""
    from pacekit.operators import history as H
    from pacekit.operators.prefix import add_history_segmented
    df = spark.range(600).select(F.lit(1).alias("runner_id"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                 F.col("id").alias("race_id"), F.col("id").alias("result_id"), (1000 + F.col("id") % 7).cast("double").alias("speed_kmh"),
                                 F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("double")).alias("speed_z_race"))
    a = {r.result_id: r for r in add_history_segmented(df, n_parts=200).collect()}
    b = {r.result_id: r for r in H.add_history(df, segmented=False).collect()}
    for k, r in b.items():
        for c in ("prior_race_count", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z", "prior_std_z", "recent_z_roll3",
                  "days_since_last_race", "runner_history_years"):
            x, y = a[k][c], r[c]
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9), (k, c, x, y)


def test_repeated_probes_get_one_answer(spark):
    from pacekit.plans import scoring as S
    from pacekit.sources import adapters
    from conftest import SF_SMALL
    fact, races = adapters.results(spark, SF_SMALL, with_positions=False), adapters.dim_race(spark, SF_SMALL)
    probe = fact.select("runner_id", (F.col("race_id") + 1).cast("int").alias("race_id")).orderBy("runner_id", "race_id").limit(3)
    assert S.asof_features(fact, races, probe.union(probe)).count() == S.asof_features(fact, races, probe).count()
    assert S.whatif(fact, races, probe.union(probe)).count() == 2 * probe.count()


def test_rows_without_a_year_are_in_no_set(spark):
    from pacekit.plans import model as M
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, None)], "source_result_id long, year int")
    assert {r.source_result_id: r.split for r in M.temporal_split(df).collect()} == {1: "train", 2: "test", 3: None}


def test_fixture_name_pairs(spark):
    rows = []
    def add(name, sex, speed, races):
        for k, rk in enumerate(races):
            rows.append((f"{name}", sex, speed, rk))
    add("JEAN DUPONT", "H", 12.0, ["r1", "r2", "r3"])
    add("DUPONT JEAN", "H", 13.5, ["r4", "r5", "r6"])          # speed diff 1.5: 95.0 -> merged
    add("ABDULLAHI MOHAMED", "H", 11.0, ["r1", "r2", "r3"])
    add("ABDULLANI MOHAMED", "H", 11.2, ["r7", "r8", "r9"])    # 94.1 -> 94.7: not merged
    df = spark.createDataFrame(rows, "Nom string, Sexe string, speed_kmh double, racekey string")
    res = RV.resolve_names(df)
    pairs = {(r.name_1, r.name_2): r.final_score for r in res["pairs"].collect()}
    assert pairs == {("DUPONT JEAN", "JEAN DUPONT"): 95.0}


def test_results_independent_of_partitioning(spark):
    r = adapters.results(spark, SF_SMALL, with_positions=False)
    a = add_group_zscore(r, median=True).select("result_id", "speed_z_race", "race_median_speed")
    b = add_group_zscore(r.repartition(13, "runner_id"), median=True).select("result_id", "speed_z_race",
                                                                              "race_median_speed")
    norm = lambda rows: sorted((x[0], round(x[1] or 0, 9), x[2]) for x in rows)
    assert norm(a.collect()) == norm(b.collect())


def test_segmented_history_equals_windows_with_hot_entity(spark):
    from pacekit.operators.history import add_history_windows
    from pacekit.operators.prefix import add_history_segmented
    r = add_group_zscore(adapters.results(spark, SF_SMALL, with_positions=False), median=False)
    hot = (r.withColumn("runner_id", F.when(F.col("result_id") % 3 == 0, F.lit(-1)).otherwise(F.col("runner_id")))
            .withColumn("date", F.when(F.col("result_id") % 11 == 0, F.lit(None)).otherwise(F.col("date"))))
    cols = ["result_id", "prior_race_count", "prior_avg_speed", "prior_std_speed", "prior_best_speed", "prior_avg_z",
            "prior_std_z", "prior_best_z", "recent_speed_roll3", "recent_z_roll3", "days_since_last_race",
            "runner_history_years"]
    a = {x[0]: x[1:] for x in add_history_windows(hot).select(*cols).collect()}
    b = {x[0]: x[1:] for x in add_history_segmented(hot, n_parts=16).select(*cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None)
            if x is not None:
                assert abs(x - y) <= 1e-9 * max(1.0, abs(x))


def test_segmented_asof_equals_window_asof_with_hot_runner(spark):
    from pacekit.plans import reports as R
    from pacekit.plans import scoring as S
    fact = adapters.results(spark, SF_SMALL, with_positions=False)
    hot = fact.withColumn("runner_id", F.when(F.col("result_id") % 3 == 0, F.lit(7)).otherwise(F.col("runner_id")))
    hot = hot.groupBy("runner_id", "race_id").agg(F.min_by(F.struct(*[c for c in hot.columns
                                                                     if c not in ("runner_id", "race_id")]),
                                                           "result_id").alias("r")).select("runner_id", "race_id", "r.*")
    races = adapters.dim_race(spark, SF_SMALL)
    probes = R.not_run_races(hot, races, hot).select("runner_id", "race_id")
    key = ["runner_id", "race_id"]
    a = {tuple(x[:2]): x[2:] for x in S.asof_features(hot, races, probes, segmented=False).orderBy(*key).collect()}
    b = {tuple(x[:2]): x[2:] for x in S.asof_features(hot, races, probes, segmented=True).orderBy(*key).collect()}
    assert a.keys() == b.keys() and len(a) > 0
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None)
            if x is not None:
                assert abs(x - y) <= 1e-9 * max(1.0, abs(x))


@pytest.mark.parametrize("itself", [True, False])
def test_short_names_meet_without_the_index(spark, monkeypatch, itself):
    """Names that share most of their text meet by equal rests alone, on one side and on two, against all pairs."""
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("ABC") for _ in range(rng.randint(0, 4))) for _ in range(40)})
    rows = [((w + " " + base).strip(), k) for base in ("COLD GEAR", "COLD GEAR LARGE", "X") for w in words for k in ("H", "F")]
    rows += [("", "H"), ("A" * 26, "H"), ("A" * 27, "H"), ("A" * 25, "H"), ("é漢" * 9, "F"), ("é漢" * 8 + "é", "F")]
    indexed, index = [], RV._index
    monkeypatch.setattr(RV, "_index", lambda keys, *a: indexed.append(keys) or index(keys, *a))
    both = [spark.createDataFrame([r for i, r in enumerate(rows) if itself or i % 3 != side], "k string, s string") for side in (0, 1)]
    got = RV.similar_pairs(both[0], both[0] if itself else both[1], "k", ["s"]).collect()
    left, right = ([tuple(r) for r in b.collect() if r.k] for b in both)
    want = {(s, a, b, lcs_dp(a, b)) for a, s in left for b, t in right if s == t
            and abs(len(a) - len(b)) <= 2 and len(a) + len(b) - 2 * lcs_dp(a, b) <= (101 * (len(a) + len(b))) // 1800}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert max(len(r.k) for r in indexed[0].select("k").collect()) == 27 and indexed[0].count() <= 2


def test_small_groups_are_compared_without_taking_strings_apart(spark, monkeypatch):
    """Two sides in groups of many sizes, one of them null, against all pairs of a group; only the large group's strings get rests."""
    rng = random.Random(9)
    def near(base):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(["", "A", "BC", "é"])
        return "".join(t)
    bases = ["COLD GEAR LARGE", "OLD GEAR", "A " * 14 + "LONG NAME", "B " * 30 + "LONGER NAME THAN SIXTY TWO"]
    sizes = {"one": (1, 1), "few": (2, 5), "wide": (3, 40), "left": (4, 0), "right": (0, 4), "large": (30, 30), None: (9, 9)}
    sides = [[(near(rng.choice(bases)), g) for g, n in sizes.items() for _ in range(n[side])] for side in (0, 1)]
    sides[0] += [(b, g) for b in bases for g in ("few", "large")]
    sides[1] += [(b, g) for b in bases for g in ("few", "large")]
    apart, pairs, index = [], RV._short_pairs, RV._index
    monkeypatch.setattr(RV, "_short_pairs", lambda left, right, *a: apart.extend((left, right)) or pairs(left, right, *a))
    monkeypatch.setattr(RV, "_index", lambda keys, *a: apart.append(keys) or index(keys, *a))
    both = [spark.createDataFrame(rows, "k string, s string") for rows in sides]
    got = [tuple(r) for r in RV.similar_pairs(*both, "k", ["s"]).collect() if r.s]
    want = {(s, a, b, lcs_dp(a, b)) for a, s in set(sides[0]) for b, t in set(sides[1]) if s and s == t
            and len(a) + len(b) - 2 * lcs_dp(a, b) <= (101 * (len(a) + len(b))) // 1800}
    assert len(got) == len(want) and set(got) == want and {s for s, *_ in want} >= {"few", "wide", "large"}
    assert {r.s for keys in apart for r in keys.select("s").distinct().collect()} - {None} == {"large"}
