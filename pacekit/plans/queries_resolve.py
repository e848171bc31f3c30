"""Registered entity-resolution queries on the names adapter.

The oracle SQL is the brute force: every pair is scored (bit-parallel LCS in
DuckDB list lambdas), the reference's rules are applied literally.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resolve as RV
from ..session import cut_lineage
from ..sources import adapters
from .catalog import register
from .queries_cleaning import _block_sql, _key_sql
from .oracle import with_ctes


def _ts_sql(k):
    return f"array_to_string(list_sort(list_filter(string_split({k}, ' '), lambda t: t <> '')), ' ')"


def _lcs_sql(a, b):
    """LCS of strings a (length <= 62) and b, bit-parallel, DuckDB lambdas."""
    M = f"((1::BIGINT << length({a})::INTEGER) - 1)"
    masks = (f"list_transform(string_split({b}, ''), lambda ch: CAST(list_sum(list_transform(range(length({a})), "
             f"lambda i: CASE WHEN substr({a}, (i + 1)::BIGINT, 1) = ch THEN 1::BIGINT << i::INTEGER ELSE 0::BIGINT END)) AS BIGINT))")
    red = f"list_reduce(list_prepend({M}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {M})"
    return f"CAST(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE bit_count((~({red})) & {M}) END AS INTEGER)"


def _final_x10_sql(lcs2, T, sp):
    num = f"(900 * ({lcs2}) + ({sp}) * ({T}))"
    q = f"({num} // ({T}))"
    r2 = f"(({num} - {q} * ({T})) * 2)"
    return (f"(CASE WHEN ({T}) = 0 THEN 900 + 10 * ({sp}) WHEN {r2} > ({T}) THEN {q} + 1 "
            f"WHEN {r2} = ({T}) AND {q} % 2 = 1 THEN {q} + 1 ELSE {q} END)")


def _sp_sql(d):
    return f"(CASE WHEN {d} < 0.5 THEN 100 WHEN {d} < 1 THEN 80 WHEN {d} < 2 THEN 50 ELSE 0 END)"


NAMES_CTE = f"""
_nb AS (SELECT p_partkey, p_name, p_size, upper(concat_ws(' ', p_name, p_type,
          CASE WHEN p_partkey % 10 = 3 THEN p_name || ' ' || p_type END,
          translate(CAST(p_partkey // 1000 AS VARCHAR), '0123456789', 'ABCDEFGHIJ'))) AS b FROM part),
names AS (
  SELECT p_partkey AS row_id,
    CASE WHEN p_partkey % 7 = 0 THEN array_to_string(list_reverse(string_split(b, ' ')), ' ')
         WHEN p_partkey % 13 = 0 THEN substr(b, 1, length(b) - 2) || substr(b, length(b), 1)
         ELSE b END AS "Nom",
    CASE WHEN length(p_name) % 2 = 0 THEN 'H' ELSE 'F' END AS "Sexe",
    8.0::DOUBLE + (length(b) % 5) + p_size / 100.0::DOUBLE AS speed_kmh,
    'e' || CAST(p_partkey % 997 AS VARCHAR) AS racekey
  FROM _nb),
nm AS (SELECT *, {_key_sql('"Nom"')} AS nom_clean FROM names),
fr AS (SELECT * FROM nm WHERE nom_clean IN (SELECT nom_clean FROM nm GROUP BY nom_clean HAVING count(*) >= 3))
"""


def _profiles_sql(src, name="prof"):
    return f"""
{name}_sx AS (SELECT nom_clean, "Sexe", count(*) AS n FROM {src} WHERE "Sexe" IS NOT NULL GROUP BY 1, 2),
{name}_mode AS (SELECT nom_clean, "Sexe" AS sexe FROM {name}_sx
               QUALIFY row_number() OVER (PARTITION BY nom_clean ORDER BY n DESC, "Sexe") = 1),
{name} AS (SELECT a.nom_clean, count(*) AS n_races, m.sexe, avg(speed_kmh) AS mean_speed
           FROM {src} a LEFT JOIN {name}_mode m USING (nom_clean) GROUP BY a.nom_clean, m.sexe)"""


PASS1_CTE = _profiles_sql("fr", "prof1") + f""",
p1 AS (SELECT *, {_ts_sql('nom_clean')} AS ts FROM prof1),
pp AS (SELECT a.nom_clean AS name_1, b.nom_clean AS name_2, a.n_races AS races_1, b.n_races AS races_2,
              a.mean_speed AS speed_1, b.mean_speed AS speed_2,
              CASE WHEN length(a.ts) <= length(b.ts) THEN a.ts ELSE b.ts END AS xa,
              CASE WHEN length(a.ts) <= length(b.ts) THEN b.ts ELSE a.ts END AS yb,
              length(a.ts) + length(b.ts) AS tl
       FROM p1 a JOIN p1 b ON a.nom_clean < b.nom_clean AND a.sexe IS NOT DISTINCT FROM b.sexe),
pl AS (SELECT *, {_lcs_sql('xa', 'yb')} AS lcs FROM pp),
ps AS (SELECT *, CASE WHEN tl = 0 THEN 100.0 ELSE 200.0 * lcs / tl END AS name_score,
              {_sp_sql('abs(speed_1 - speed_2)')} AS speed_score FROM pl),
pf AS (SELECT *, {_final_x10_sql('2 * lcs', 'tl', 'speed_score')} AS final_x10 FROM ps),
ev AS (SELECT DISTINCT nom_clean, racekey FROM fr),
pairs AS (SELECT name_1, name_2, races_1, races_2, name_score, speed_score, final_x10 / 10.0 AS final_score,
                 CASE WHEN races_1 >= races_2 THEN name_1 ELSE name_2 END AS canonical,
                 CASE WHEN races_1 >= races_2 THEN name_2 ELSE name_1 END AS other
          FROM pf WHERE final_x10 >= 950
            AND NOT EXISTS (SELECT 1 FROM ev e1 JOIN ev e2 ON e1.racekey = e2.racekey
                            WHERE e1.nom_clean = pf.name_1 AND e2.nom_clean = pf.name_2)),
corr1 AS (SELECT other, canonical FROM pairs
          QUALIFY row_number() OVER (PARTITION BY other ORDER BY name_1 DESC, name_2 DESC) = 1),
nm1 AS (SELECT nm.* REPLACE (coalesce(c.canonical, nm.nom_clean) AS nom_clean) FROM nm LEFT JOIN corr1 c ON nm.nom_clean = c.other)"""

PASS2_CTE = _profiles_sql("nm1", "prof2") + f""",
q2 AS (SELECT *, {_ts_sql('nom_clean')} AS ts, {_block_sql('nom_clean')} AS blk FROM prof2),
cand AS (SELECT r.nom_clean AS rare_name, f.nom_clean AS freq_name, r.sexe AS rare_sex, f.sexe AS freq_sex,
                r.mean_speed AS rare_speed, f.mean_speed AS freq_speed,
                CASE WHEN length(r.ts) <= length(f.ts) THEN r.ts ELSE f.ts END AS xa,
                CASE WHEN length(r.ts) <= length(f.ts) THEN f.ts ELSE r.ts END AS yb,
                length(r.ts) + length(f.ts) AS tl
         FROM q2 r JOIN q2 f ON r.blk = f.blk WHERE r.n_races < 3 AND f.n_races >= 3),
cl AS (SELECT *, {_lcs_sql('xa', 'yb')} AS lcs FROM cand),
cs AS (SELECT *, CASE WHEN tl = 0 THEN 100.0 ELSE 200.0 * lcs / tl END AS name_score FROM cl),
ck AS (SELECT *, CAST(row_number() OVER (PARTITION BY rare_name ORDER BY name_score DESC, freq_name) AS INTEGER) AS rank
       FROM cs QUALIFY rank <= 5),
acc AS (SELECT *, {_sp_sql('abs(rare_speed - freq_speed)')} AS speed_score FROM ck
        WHERE name_score >= 85 AND rare_sex IS NOT DISTINCT FROM freq_sex),
acc2 AS (SELECT *, {_final_x10_sql('2 * lcs', 'tl', 'speed_score')} AS final_x10 FROM acc),
matches AS (SELECT rare_name, freq_name, rank, name_score, speed_score, final_x10 / 10.0 AS final_score,
                   freq_name = last_value(freq_name) OVER (PARTITION BY rare_name ORDER BY name_score DESC, freq_name
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS chosen
            FROM acc2 WHERE final_x10 >= 950),
nm2 AS (SELECT nm1.* REPLACE (coalesce(m.freq_name, nm1.nom_clean) AS nom_clean)
        FROM nm1 LEFT JOIN (SELECT * FROM matches WHERE chosen) m ON nm1.nom_clean = m.rare_name)"""

ALL = (NAMES_CTE, PASS1_CTE, PASS2_CTE)


_RESOLVED: dict = {}


def _resolved(spark, sf):
    """One resolution run per application and scale factor (its pass outputs are checkpointed)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RESOLVED:
        _RESOLVED[key] = RV.resolve_names(adapters.names(spark, sf))
    return _RESOLVED[key]


@register("entity_profiles", with_ctes("SELECT nom_clean AS \"Nom_clean\", n_races, sexe, mean_speed FROM prof0",
                                       NAMES_CTE, _profiles_sql("nm", "prof0")), doubles=("mean_speed",))
def entity_profiles(spark, sf):
    rows = adapters.names(spark, sf).withColumn("Nom_clean", RV.match_key("Nom"))
    return RV.profiles(rows)


@register("token_sort_ratio", with_ctes(f"""
SELECT name_1, name_2, lcs, name_score FROM ps WHERE tl - 2 * lcs <= (101 * tl) // 1800""", *ALL[:2]),
          doubles=("name_score",))
def token_sort_ratio(spark, sf):
    """Pass-1 candidate pairs (same sex) whose Indel distance allows a final score of 95, with F15."""
    rows = adapters.names(spark, sf).withColumn("Nom_clean", RV.match_key("Nom"))
    cnt = rows.groupBy("Nom_clean").agg(F.count(F.lit(1)).alias("c")).where("c >= 3")
    prof = cut_lineage(RV.profiles(rows.join(cnt.hint("merge"), "Nom_clean", "left_semi")))     # read three times
    p = prof.withColumn("_ts", RV.token_sort("Nom_clean")).withColumn("_sx", F.coalesce("sexe", F.lit("\u0000")))
    keyed = p.select("_ts", "_sx")
    sim = RV.similar_pairs(keyed, keyed, "_ts", ["_sx"])  # same object: self-similarity mode
    a = p.select(F.col("Nom_clean").alias("name_1"), F.col("_ts").alias("l_key"), "_sx")
    b = p.select(F.col("Nom_clean").alias("name_2"), F.col("_ts").alias("r_key"), "_sx")
    j = sim.join(a.hint("merge"), ["l_key", "_sx"]).join(b.hint("merge"), ["r_key", "_sx"]).where(F.col("name_1") < F.col("name_2"))
    T = F.length("l_key") + F.length("r_key")
    return j.select("name_1", "name_2", "lcs", (F.lit(200.0) * F.col("lcs") / T).alias("name_score")).distinct()


@register("frequent_pairs", with_ctes("""
SELECT name_1, name_2, races_1, races_2, name_score, speed_score, final_score, canonical, other FROM pairs""", *ALL[:2]),
          doubles=("name_score", "final_score"))
def frequent_pairs(spark, sf):
    return _resolved(spark, sf)["pairs"]


@register("rare_matches", with_ctes("""
SELECT rare_name, freq_name, rank, name_score, speed_score, final_score, chosen FROM matches""", *ALL),
          doubles=("name_score", "final_score"))
def rare_matches(spark, sf):
    return _resolved(spark, sf)["matches"]


@register("corrected_names", with_ctes("""
SELECT row_id, "Nom", nom_clean AS "Nom_clean" FROM nm2""", *ALL))
def corrected_names(spark, sf):
    return _resolved(spark, sf)["rows"].select("row_id", "Nom", "Nom_clean")


@register("name_report", with_ctes("""
SELECT (SELECT count(*) FROM corr1) + (SELECT count(*) FROM matches WHERE chosen) AS corrections,
       count(DISTINCT "Nom") AS unique_before, count(DISTINCT nom_clean) AS unique_after,
       count(DISTINCT "Nom") - count(DISTINCT nom_clean) AS reduction
FROM nm2""", *ALL))
def name_report(spark, sf):
    r = _resolved(spark, sf)
    return RV.correction_report(r["rows"], r["pass1"], r["pass2"])


@register("entity_events", with_ctes("""
SELECT nom_clean AS "Nom_clean", count(DISTINCT racekey) AS n_events,
       array_to_string(list_sort(list(DISTINCT racekey)), ',') AS events
FROM fr GROUP BY nom_clean""", NAMES_CTE))
def entity_events(spark, sf):
    """Set of events per frequent entity (deduplicated map-side by collect_set)."""
    rows = adapters.names(spark, sf).withColumn("Nom_clean", RV.match_key("Nom"))
    cnt = rows.groupBy("Nom_clean").agg(F.count(F.lit(1)).alias("c")).where("c >= 3")
    fr = rows.join(cnt, "Nom_clean", "left_semi")
    return fr.groupBy("Nom_clean").agg(F.count_distinct("racekey").alias("n_events"),
                                       F.array_join(F.array_sort(F.collect_set("racekey")), ",").alias("events"))
