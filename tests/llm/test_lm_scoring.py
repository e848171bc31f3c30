import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pacekit.llm import lm_scoring as L


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def train(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0


def expected(rows, rate):
    """Base and model by dictionaries over all training rows; ``rate`` gives a context's backoff weight."""
    words, pairs, context = Counter(), Counter(), Counter()
    for i, t, *_ in rows:
        if train(i):
            ts = tokens(t)
            words.update(ts)
            for h, w in zip([None, *ts], ts):
                pairs[h, w] += 1
                context[h] += 1
    n, v = sum(words.values()), len(words)
    low = lambda w: (words[w] + 0.1) / (n + 0.1 * (v + 1))                                       # noqa: E731
    out = []
    for i, t, *_ in rows:
        ts, score = tokens(t), 0.0
        for h, w in zip([None, *ts], ts):
            if context[h]:
                m = rate(context[h])
                score += math.log10((1 - m) * pairs[h, w] / context[h] + m * low(w))
            else:
                score += math.log10(low(w))
        out.append((str(i), not train(i), len(ts), sum(words[w] > 0 for w in ts), n, sum(math.log10(low(w)) for w in ts), score))
    return sorted(out)


def learn(c="doc_id"):
    return L.fold(F.col(c)) % 10 != 0


def same(got, want):
    got = sorted((str(r[0]), *r[1:]) for r in map(tuple, got))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.fixture
def fixed_rates(monkeypatch):
    """Backoff weights that do not depend on how rows are cut into chunks."""
    rates = np.linspace(0.9, 0.2, L._LEVELS)
    init = L.Totals.__init__

    def own(self, *a):
        init(self, *a)
        self.backoff = rates
    monkeypatch.setattr(L.Totals, "__init__", own)
    return lambda c: rates[math.frexp(c)[1]]


@pytest.mark.parametrize("block,shard", [(16_000_000, 24_000_000), (3000, 5000), (1, 10**9)])
def test_against_brute_force(spark, odd_docs, odd_rows, clashing, fixed_rates, block, shard):
    want = expected(odd_rows, fixed_rates)
    for docs in (odd_docs, clashing):
        got = L.score(docs.repartition(3), learn(), block_bytes=block, shard_bytes=shard)
        assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        same(got.collect(), want)


def test_estimated_rates(odd_rows):
    """The share of pairs that are single, by how often their context stands in a chunk."""
    texts = [(r[1] or "").encode() for r in odd_rows]
    rows = L._pieces(L.Chunk(texts, np.ones(len(texts), bool)), "b", 0, 3)
    sums = L.unpack_counts(rows[rows["kind"] == 0]["counts"].iloc[0])
    context, pairs = Counter(), Counter()
    for t in texts:
        ts = tokens(t.decode())
        for h, w in zip([None, *ts], ts):
            context[h] += 1
            pairs[h, w] += 1
    context.setdefault(b"", sum(1 for _ in texts))                 # the end is no context, but a word
    seen, single = np.zeros(L._LEVELS), np.zeros(L._LEVELS)
    for h, c in context.items():
        seen[math.frexp(c)[1]] += c
    for (h, _), c in pairs.items():
        single[math.frexp(context[h])[1]] += c == 1
    assert sums[:2].tolist() == [sum(len(tokens(t.decode())) for t in texts), len(texts)]
    assert sums[2:2 + L._LEVELS].tolist() == seen.tolist() and sums[2 + L._LEVELS:].tolist() == single.tolist()


def test_probabilities_of_a_context_sum_to_one():
    texts = [b"a b a c", b"a b", b"d a b", b"", b"c c c"]
    chunk = L.Chunk(texts + [b"unseen"], np.array([True] * 5 + [False]))
    words, pairs = chunk.word_counts, chunk.pair_counts
    totals = L.Totals(chunk.n_tokens, int((words > 0).sum()), chunk.n_rows, np.ones(L._LEVELS), np.full(L._LEVELS, 3.0))
    m = L.build(chunk, words, pairs, totals)
    end = int(np.searchsorted(chunk.words, np.uint64(xxhash.xxh3_64_intdigest(b""))))
    for state in set(range(len(words) + 2)) - {end + 1}:            # nothing follows the end
        after = lambda k: 10 ** m.run(np.array([[k]]), np.array([state]))[0][0]                    # noqa: E731
        assert abs(sum(after(k + 1) for k in range(len(words)) if words[k]) + after(10**6) - 1) < 1e-9


def test_the_automaton_against_a_walk_by_hand():
    """Failure arcs over several states, many texts side by side, cut anywhere."""
    rng = np.random.default_rng(2)
    n, states = 6, 30
    fail = np.array([0] + [int(rng.integers(0, k)) for k in range(1, states)])
    arcs = {(0, s): (float(rng.random()), s) for s in range(1, n + 1)}
    arcs |= {(int(rng.integers(1, states)), int(rng.integers(1, n + 1))): (float(rng.random()), int(rng.integers(0, states))) for _ in range(60)}
    order = sorted(arcs)
    fw = rng.random(states)
    m = L.Automaton(n, np.array([q << 32 | s for q, s in order]), np.array([arcs[k][0] for k in order]), np.array([arcs[k][1] for k in order]), fail, fw, -9.0)

    def walk(text, q):
        total = 0.0
        for s in text:
            while (q, s) not in arcs and q:
                total, q = total + fw[q], fail[q]
            w, q = arcs.get((q, s), (-9.0, 0))
            total += w
        return total
    texts = [rng.integers(1, n + 3, int(rng.integers(1, 40))) for _ in range(50)]
    start = rng.integers(0, states, 50)
    padded = np.zeros((40, 50), np.int64)
    for k, t in enumerate(texts):
        padded[:len(t), k] = t
    assert np.allclose(m.run(padded, start)[0], [walk(t.tolist(), q) for t, q in zip(texts, start.tolist())])


def test_tokens_of_a_column(odd_rows):
    texts = [(r[1] or "").encode() for r in odd_rows] + [b"\x0b a\x1cb\x85 A\xff ", b"\xc3\x89 \xe2\x80\x83x"]
    every, sizes, kinds = L.tokenised(texts)
    got = [[kinds[k] for k in part] for part in np.split(every, np.cumsum(sizes)[:-1])]
    assert got == [t.lower().split() + [b""] for t in texts]


def test_held_out_texts_score_above_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.score(docs, learn(), from_files=True)
    r = got.where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert r[2] > 50 and r[0] > r[1]
    # cut into many blocks and shards, the counts are the same
    small = L.score(docs, learn(), from_files=True, block_bytes=100_000, shard_bytes=100_000).orderBy("doc_id").collect()
    for a, b in zip(got.orderBy("doc_id").collect(), small):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6


def test_without_rows_or_training(spark, odd_docs, odd_rows, no_docs):
    assert L.score(no_docs, learn()).count() == 0
    got = L.score(odd_docs, F.lit(False)).collect()
    assert len(got) == len(odd_rows) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and abs(r["score"]) < 1e-9 for r in got)


def test_packing_round_trips():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 2**64, n, np.uint64))
        assert np.array_equal(L.unpack_keys(L.pack_keys(keys)), keys)
    for top in (0, 200, 60_000, 10**6, 10**12):
        assert L.unpack_counts(L.pack_counts(np.array([0, top]))).tolist() == [0, top]
