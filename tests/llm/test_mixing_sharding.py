import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pacekit.llm import mixing, queries, sharding
from pacekit.llm.common import n_words


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, weights, total, cap):
    """Water-filling, one excess after the other."""
    target = {s: total * weights[s] / sum(weights.values()) for s in sizes}
    capped = set()
    while over := {s for s in sizes if s not in capped and target[s] > cap * sizes[s] + 1e-9}:
        capped |= over
        for s in capped:
            target[s] = cap * sizes[s]
        free = {s: weights[s] for s in sizes if s not in capped}
        left = total - sum(target[s] for s in capped)
        for s in free:
            target[s] = left * free[s] / sum(free.values())
    return target


def test_word_counts(odd_docs):
    assert all(r["n"] == size(r["text"]) for r in odd_docs.select("text", n_words(F.col("text")).alias("n")).collect())


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 10, "c": 500, None: 40}, {"a": 5, "b": 5}, {"x": 0, "y": 7, "z": 3}, {"only": 9}])
def test_water_fill(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    weighted = mixing.cyclic_weights(df, (3, 1, 2))
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    assert {r["source"]: r["weight"] for r in weighted.collect()} == weights
    total = 1.5 * sum(sizes.values())
    got = {r["source"]: r["target"] for r in mixing.water_fill(weighted, total, 2).collect()}
    expected = filled(sizes, weights, total, 2)
    assert all(abs(got[s] - expected[s]) < 1e-6 for s in sizes)


def test_water_fill_beyond_all_caps(spark):
    df = spark.createDataFrame([("a", 3.0, 10), ("b", 1.0, 4)], "source string, weight double, size long")
    assert {r["source"]: r["target"] for r in mixing.water_fill(df, 100.0, 2).collect()} == {"a": 20.0, "b": 8.0}


def test_mix_comes_to_the_word(odd_docs, odd_rows):
    rows = mixing.mix(mixing.sized(odd_docs)).collect()
    assert len(rows) == len(odd_rows) and all(r["whole"] * r["size"] + r["part"] <= 2 * r["size"] for r in rows)
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["whole"] * r["size"] + r["part"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) < 1 for s in target)
    again = mixing.mix(mixing.sized(odd_docs.repartition(7))).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))


def test_mixture_repeats_the_rows(odd_docs, clashing, no_docs):
    plan = mixing.mix(mixing.sized(odd_docs)).groupBy("source").agg(F.max("target").alias("t")).collect()
    target = {r["source"]: r["t"] for r in plan}
    for docs in (odd_docs, clashing):
        out = mixing.mixture(docs)
        assert out.columns == docs.columns
        taken = Counter()
        for r in out.select("source", "text").collect():
            taken[r["source"]] += size(r["text"])
        assert all(abs(taken[s] - target[s]) < 1 for s in target)
    assert mixing.mixture(no_docs).count() == 0


def test_mix_oracle_order(spark, tmp_path, odd_docs):
    """The fractional repetition follows the seeded order: no row behind the border is taken."""
    rows = mixing.mix(mixing.sized(odd_docs.where("doc_id < 60"))).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    for group in by.values():
        left = int(group[0]["target"]) - group[0]["whole"] * sum(r["size"] for r in group)
        for r in sorted(group, key=lambda r: r["draw"]):
            assert r["part"] == max(0, min(r["size"], left))
            left -= r["part"]


def test_shards_match_the_mixture(odd_docs, odd_rows, no_docs, clashing):
    for shards in (1, 4, 16, 200):
        got = sharding.shard_documents(odd_docs, shards).collect()
        counts = Counter(r["shard"] for r in got)
        per = [counts.get(s, 0) for s in range(shards)]
        assert sum(per) == len(odd_rows) and max(per) - min(per) <= 1
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
            raw = next(x[1] for x in odd_rows if x[0] == r["doc_id"] and (r["doc_id"] is not None or x[1] is None or r["size"] > 1)) or ""
            if r["doc_id"] is not None:
                assert r["size"] == len(raw.encode()) + 1 and r["text_crc32"] == zlib.crc32(raw.encode())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sources = Counter(r["source"] for r in got)
        in_shard = Counter((r["source"], r["shard"]) for r in got)
        for s, n in sources.items():
            each = [in_shard.get((s, k), 0) for k in range(shards)]
            assert max(each) <= n / shards + len(sources) + 1 and min(each) >= n / shards - len(sources) - 1
    assert sharding.shard_documents(no_docs).count() == 0
    assert sharding.shard_documents(clashing).count() == len(odd_rows)


def test_sharding_is_the_same_again(odd_docs):
    docs = odd_docs.where("doc_id IS NOT NULL")
    assert sorted(map(str, sharding.shard_documents(docs, 5).collect())) == sorted(map(str, sharding.shard_documents(docs.repartition(9), 5).collect()))
    assert {"op6_mixing", "op9_sharding"} <= set(queries.QUERIES)


def test_mixture_of_whole_documents(odd_docs):
    plan = mixing.mix(mixing.sized(odd_docs)).collect()
    target, longest = {}, Counter()
    for r in plan:
        target[r["source"]] = r["target"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    texts = {r["text"] for r in odd_docs.select("text").collect()}
    taken = Counter()
    for r in mixing.mixture(odd_docs, whole_documents=True).select("source", "text").collect():
        assert r["text"] in texts
        taken[r["source"]] += size(r["text"])
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in target)
    assert any(r["text"] not in texts for r in mixing.mixture(odd_docs).collect())
