import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from pacekit.llm import graph, simhash


def fingerprint(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, tau):
    """Smallest index reachable, by comparing all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= tau:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_of_whole_texts(odd_docs, odd_rows):
    got = odd_docs.select("n_chars", "text", simhash.fingerprint(F.col("text")).alias("fp")).collect()
    assert all(r["fp"] == signed(fingerprint(r["text"])) for r in got) and len(got) == len(odd_rows)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000)).encode()
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    assert simhash.simhash(text) == whole


@pytest.mark.parametrize("tau,m,bucket", [(2, 3, 32), (2, 4, 2), (2, 3, 1), (1, 2, 2), (1, 3, 32), (0, 2, 1)])
def test_links_keep_every_component(spark, tau, m, bucket):
    rng = random.Random(tau * 10 + m)
    values = {0, (1 << 64) - 1}
    for _ in range(12):                       # families around a centre, chains, and strangers
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    edges = simhash.links(df, tau, m, bucket)
    pairs = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in edges.collect()]
    assert all((a ^ b).bit_count() <= tau for a, b in pairs)
    found = {r["node"] & (2**64 - 1): r["root"] & (2**64 - 1) for r in graph.components(edges).collect()}
    expected = classes(values, tau)
    groups = {}
    for v, c in zip(values, expected):
        groups.setdefault(c, set()).add(v)
    for group in groups.values():
        roots = {found.get(v, v) for v in group}
        assert len(roots) == 1 and roots <= group
    assert edges.count() <= 65 * len(values)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (7, 8), (8, 7)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}


def test_near_duplicates_of_odd_rows(odd_docs, odd_rows):
    got = sorted(((r["id"], r["fp"], r["component"]) for r in simhash.near_duplicates(odd_docs).collect()), key=str)
    values = [fingerprint(r[1]) for r in odd_rows]
    roots = classes(values, 2)
    least = {}
    for r, c in zip(odd_rows, roots):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    assert got == sorted(((r[0], signed(v), least.get(c)) for r, v, c in zip(odd_rows, values, roots)), key=str)


def test_dedup_keeps_one_row_of_each_group(odd_docs, odd_rows, clashing, no_docs):
    kept = simhash.dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    roots = classes([fingerprint(r[1]) for r in odd_rows], 2)
    assert kept.count() == len(set(roots))
    text_of = {fingerprint(r["text"]) for r in kept.collect()}
    assert len(classes(sorted(text_of), 2)) == len(set(roots))
    assert simhash.dedup(clashing).columns == clashing.columns and simhash.dedup(clashing).count() == len(set(roots))
    assert simhash.dedup(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def test_dedup_of_ids_with_different_texts(spark):
    one, two, three = (" ".join(f"{a}{i}" for i in range(40)) for a in ("alpha", "beta", "gamma"))
    # 5 loses to 1 in the first group and is the smallest id of the second; 7 is that of two groups
    rows = [(1, one), (5, one), (5, two), (5, two), (9, two), (7, three), (7, three[::-1])]
    kept = simhash.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, one), (5, two), (7, three), (7, three[::-1])])
