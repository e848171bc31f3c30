import numpy as np
import pytest

from pacekit.llm import ann


def brute(rows, k, queries):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, x in good:
        if q % queries:
            continue
        scored = []
        for c, y in good:
            if c != q and len(y) == len(x):
                s = 0.0
                for a, b in zip(x, y):
                    s += a * b
                scored.append((-s, c))
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_exact_against_brute_force(spark, block):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]                       # a common vector: ties
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [1.0] * 15 + [float("inf")]), (504, [None] + [1.0] * 15),
             (505, [1.0, 2.0]), (510, [3.0, -1.0]), (520, []), (None, [1.0] * 16), (530, [1e-30] * 16), (540, [1e30] + [1.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(df.where("vec_id % 10 = 0"), df, k=20, block_rows=block, query_rows=block)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute(exact, 20, 10)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [0.5, 1.0], "y"), (1, [1.0, 0.0], "z")], "vec_id long, embedding array<double>, rank string")
    assert [tuple(r) for r in ann.search(df, df, k=5).orderBy("query_id").collect()] == [(1, 1, 2, 0.5), (2, 1, 1, 0.5)]
    none = df.where("vec_id > 9")
    assert ann.search(none, df).count() == 0 and ann.search(df, none).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for scale in (1e-3, 1.0, 1e4):
        q, c = rng.normal(size=(50, 24)) * scale, rng.normal(size=(400, 24)) ** 3
        got = ann.tile(np.arange(50), q, np.arange(1000, 1400), c, 5, step=16)
        best = np.sort(-(q @ c.T), axis=1)[:, :5]
        assert np.allclose(-best.ravel(), got.sort_values(["query_id", "score"], ascending=[True, False])["score"])
