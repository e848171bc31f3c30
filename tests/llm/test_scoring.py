import inspect
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pacekit.llm import quality_classifier, toxicity
from pacekit.llm.licenses import words

INSULTS = ["moronic", "dreckig", "scummish"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    common = [f"{a}{b}" for a in ("ga", "le", "mo", "tu", "ri", "sa", "ne", "po") for b in ("n", "rk", "st", "lia", "mu", "x")]
    rows, labels = [], []
    for i in range(700):
        ws = [rng.choice(common) for _ in range(rng.randint(20, 150))]
        bad, junk = i % 6 == 0, i % 7 == 0
        if bad:
            for _ in range(max(3, len(ws) // 15)):
                ws.insert(rng.randrange(len(ws)), rng.choice(INSULTS))
        if junk:
            ws = [w + "###" for w in ws]
        rows.append((i, " ".join(ws), "en", "s1" if i % 3 else "s2", 1))
        if i % 5:
            labels.append((i, int(not junk), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {r[0]: r for r in rows}, {r[0]: r for r in labels}


def log_ratios(model, text):
    return model.log_ratios(toxicity.Words([text])).tolist()


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(corpus):
    docs, labels, rows, truth = corpus
    model = toxicity.train(docs, labels, learn=~toxicity.held_out(F.col("doc_id")), curve_part=4)
    got = {r["doc_id"]: r["score"] for r in toxicity.add_score(docs, model).collect()}
    unseen = [i for i in rows if held(i)]
    assert all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[i] >= 0.3) == (i % 6 == 0) for i in unseen]) > 0.95
    # inputs of a score are texts only
    other = docs.withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("source", F.lit("z")).withColumn("lang", F.lit(None).cast("string"))
    again = {r["doc_id"] - 10_000: r["score"] for r in toxicity.add_score(other, model).collect()}
    assert again == got


def test_labels_of_the_held_out_fold_are_not_read(corpus):
    docs, labels, _, _ = corpus
    learn = ~toxicity.held_out(F.col("doc_id"))
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, x, learn=learn, curve_part=4) for x in (labels, flipped))
    assert np.array_equal(a.curve, b.curve) and (a.pairs, a.words, a.stems) == (b.pairs, b.words, b.stems)


def brute_ratios(rows, truth, curve_part, curve_rows, least_g2):
    """The two models and their differing expressions by dictionaries; gives the ratios of a text's tokens."""
    part = lambda i: zlib.crc32(str(i).encode()) // 4 % curve_part == 0                        # noqa: E731
    chosen = set(sorted((i for i in truth if part(i)), key=lambda i: (zlib.crc32(str(i).encode()), i))[:curve_rows])
    learned = [i for i in truth if i not in chosen]
    counts, docs, n_docs = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    for i in learned:
        ws, c = words(rows[i][1].encode()), truth[i][2]
        pairs = list(zip([None, *ws], ws))
        counts[c].update(pairs)
        docs[c].update(set(pairs) | set(ws) | {("stem", w[:5]) for w in ws})
        n_docs[c] += 1
    seen = Counter(w for r in rows.values() for w in set(words(r[1].encode())))
    by_stem = Counter()
    for w, n in seen.items():
        by_stem[w[:5]] += n

    def g2(x):
        a, b = docs[1][x], docs[0][x]
        share, (m, n) = (a + b) / sum(n_docs), n_docs
        t = lambda o, e: o * math.log(o / e) if o > 0 and e > 0 else 0.0                        # noqa: E731
        return 2 * (t(a, n * share) + t(b, m * share) + t(n - a, n * (1 - share)) + t(m - b, m * (1 - share)))

    def discount(c):
        of = Counter(c.values())
        return of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] else 0.5
    p = []
    for c in (0, 1):
        n, k, j = counts[c], Counter(w for _, w in counts[c]), None
        j = Counter(w[:5] for w in k)
        contexts, kinds = Counter(), Counter()
        for (h, _), x in n.items():
            contexts[h] += x
            kinds[h] += 1
        def stem(s, j=j, d=discount(j)):
            return max(j[s] - d, 0) / sum(j.values()) + d * len(j) / sum(j.values()) * (by_stem[s] + 0.5) / (sum(seen.values()) + 0.5)
        def word(w, k=k, d=discount(k), stem=stem):
            return max(k[w] - d, 0) / sum(k.values()) + d * len(k) / sum(k.values()) * stem(w[:5]) * (seen[w] + 0.5) / (by_stem[w[:5]] + 0.5)
        def pair(h, w, n=n, contexts=contexts, kinds=kinds, d=discount(n), word=word):
            if not contexts[h]:
                return word(w)
            return max(n[h, w] - d, 0) / contexts[h] + d * kinds[h] / contexts[h] * word(w)
        p.append((pair, word, stem))

    def ratios(text):
        ws = words(text.encode())
        for h, w in zip([None, *ws], ws):
            if g2((h, w)) >= least_g2:
                yield math.log(p[1][0](h, w) / p[0][0](h, w))
            elif g2(w) >= least_g2:
                yield math.log(p[1][1](w) / p[0][1](w))
            elif g2(("stem", w[:5])) >= least_g2:
                yield math.log(p[1][2](w[:5]) / p[0][2](w[:5]))
            else:
                yield 0.0
    return ratios


def test_scores_against_brute_force(corpus):
    docs, labels, rows, truth = corpus
    for least in (4.0, 15.0):
        model = toxicity.train(docs, labels, curve_part=3, curve_rows=50, least_g2=least)
        ratios = brute_ratios(rows, truth, 3, 50, least)
        assert model.words and model.stems and (model.pairs or least > 4)
        for i in list(rows)[:200]:
            r = list(ratios(rows[i][1]))
            assert np.allclose(log_ratios(model, rows[i][1].encode()), r, atol=1e-9)
            x = model.curve @ [1, sum(r) / len(r), sum(r) / len(r) ** 0.5, math.log1p(len(r))]
            assert abs(model.scores([rows[i][1].encode()])[0] - 1 / (1 + math.exp(-x))) < 1e-9
    got = {r["doc_id"]: r["score"] for r in toxicity.add_score(docs, model).collect()}
    assert np.allclose([got[i] for i in rows], model.scores([r[1].encode() for r in rows.values()]), atol=1e-12)


def test_rare_words_do_not_decide(corpus):
    docs, labels, _, _ = corpus
    model = toxicity.train(docs, labels)
    assert log_ratios(model, b"zzyzx qwertz gan") == [0.0, 0.0, 0.0]
    r = log_ratios(model, b"gan moronic gan Moronic")
    assert r[1] > 2 and r[3] > 2                                                                 # every occurrence counts
    assert log_ratios(model, b"moronity")[0] > 1                                                 # an inflected form, by its beginning


def test_the_model_is_bounded(corpus):
    docs, labels, _, _ = corpus
    whole, model = (toxicity.train(docs, labels, least_g2=1.0, most=n) for n in (10**6, 7))
    assert len(model.pairs) == len(model.words) == len(model.stems) == 7 < len(whole.words)
    assert all(abs(whole.words[k] - v) < 1e-9 for k, v in model.words.items())


def test_toxicity_of_odd_rows(spark, corpus, odd_docs, clashing, no_docs):
    _, labels, _, _ = corpus
    for docs in (odd_docs, clashing):
        assert toxicity.keep_clean(docs, labels).columns == docs.columns
    assert toxicity.keep_clean(no_docs, labels).count() == 0
    none = labels.where("doc_id < 0")
    model = toxicity.train(odd_docs, none)
    scores = {round(r["score"], 9) for r in toxicity.add_score(odd_docs, model).collect()}
    assert len(scores) == 1
    nulls = spark.createDataFrame([(None, 1, None), (3, None, 1), (3, 1, 0), (4, 1, 7)], "doc_id long, quality int, toxic int")
    assert toxicity.add_score(odd_docs, toxicity.train(odd_docs, nulls)).count() == odd_docs.count()


def test_quality_held_out(corpus, odd_docs, clashing, no_docs):
    docs, labels, rows, _ = corpus
    got = quality_classifier.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == int(r["doc_id"] % 7 != 0) for r in got if r["held_out"]]) > 0.97
    for d in (odd_docs, clashing):
        assert quality_classifier.classify(d, labels).count() == odd_docs.count()
    assert quality_classifier.classify(no_docs, labels).count() == 0
    blank = quality_classifier.classify(odd_docs, labels.where("doc_id < 0")).collect()
    assert all(abs(r["score"] - 0.5) < 1e-9 for r in blank)


def test_sites_shrink_level_by_level(spark):
    rows = [("h", "p", 1.0)] * 500 + [("h", "q", 1.0)] * 2 + [("g", "p", 0.0)] * 500 + [("g", "q", 1.0)] * 1 + [(None, None, 1.0)]
    got = {(r["host"], r["path"]): r for r in quality_classifier.site_rates(spark.createDataFrame(rows, "host string, path string, good double")).collect()}
    assert got["h", "p"]["path_rate"] > 0.95 and got["g", "p"]["path_rate"] < 0.05
    assert got["g", "p"]["host_rate"] < got["g", "q"]["path_rate"] < 0.9
    assert 0.4 < got[None, None]["host_rate"] < 1.0


def test_words_of_texts():
    texts = [b"a b c a", b"", "漢字 É x_y-9\x00z\x0bQ".encode(), b" .,; ", b"\xff\xfe a"]
    w = toxicity.Words(texts)
    want = [words(t) for t in texts]
    assert w.sizes.tolist() == [len(x) for x in want]
    assert [w.key[k] for k in w.every] == [toxicity.word_key(x) for ws in want for x in ws]
    assert [w.stem[k] for k in w.every] == [toxicity.word_key(x[:5]) for ws in want for x in ws]
    assert [int(k) for k in w.left] == [-1 if i == 0 else int(w.every[j - 1]) for j, i in enumerate(i for ws in want for i in range(len(ws)))]
    model = toxicity.Model({}, {}, {})
    assert model.evidence([]).shape == (0, 3) and model.evidence([b""]).tolist() == [[0.0, 0.0, 0.0]]


def test_many_texts_of_a_task_take_little_memory():
    """Counting and scoring hold the words and pairs of a small part at a time, and the sums are those of all texts at once."""
    rng = random.Random(2)
    vocabulary = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    texts = [" ".join(rng.choices(vocabulary, k=600)).encode() for _ in range(2000)]
    model = toxicity.Model({"left": [], "word": [], "ratio": []}, {toxicity.word_key(vocabulary[0].encode()): 1.5}, {})

    def peak(run):
        tracemalloc.start()
        got = run()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return got, most / 1e6
    counts, most = peak(lambda: sum(int(c["n"].sum()) for part in toxicity._in_parts(texts) for c in toxicity._counted(part, True)))
    assert counts == 3 * 600 * 2000 and most < 60
    found, most = peak(lambda: model.evidence(texts))
    assert np.allclose(found[:, 0], [1.5 * t.split().count(vocabulary[0].encode()) / 600 for t in texts]) and most < 60
    whole = [c.sort_values(["left", "word"], ignore_index=True) for c in toxicity._counted(texts[:300], False)]
    parts = [c for part in toxicity._in_parts(texts[:300]) for c in toxicity._counted(part, False)]
    assert len(parts) > len(whole) == 3
    for w in whole:
        mine = pd.concat([c for c in parts if c["kind"].iloc[0] == w["kind"].iloc[0]]).groupby(["kind", "left", "word"], as_index=False).sum()
        pd.testing.assert_frame_equal(mine, w[mine.columns], check_dtype=False)


def shuffled(frame):
    """Bytes that the exchanges of a collected query wrote."""
    total, plans = 0, [frame._jdf.queryExecution().executedPlan()]
    while plans:
        p = plans.pop()
        if "QueryStage" in p.nodeName():
            plans.append(p.plan())
        elif p.nodeName() == "AdaptiveSparkPlan":
            plans.append(p.executedPlan())
        else:
            total += p.metrics().apply("shuffleBytesWritten").value() if p.nodeName() == "Exchange" else 0
            plans += [p.children().apply(i) for i in range(p.children().size())]
    return total


def test_counting_shuffles_few_bytes_a_pair(spark, monkeypatch):
    """All expressions are counted as by brute force, and take some ten bytes each in the shuffle (as rows 20 and more)."""
    rng = random.Random(4)
    vocabulary = [f"{rng.randrange(10**6)}w" for _ in range(4000)]
    rows = [(i, " ".join(vocabulary[int(len(vocabulary) * rng.random() ** 3)] for _ in range(300)), int(i % 5 == 0)) for i in range(300)]
    rows += [(1000, None, 1), (1001, "", 0), (1002, " ., ", 0), (1003, rows[0][1], 0), (1004, "solo", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").coalesce(2)
    seen, write = [], toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, tag, *rest: (tag == "toxic-counts" and seen.append(df)) or write(df, tag, *rest))
    toxicity.train(docs.drop("toxic"), docs.drop("text"), curve_rows=0)
    got = seen[0].toPandas()
    n, d = ({k: Counter() for k in (0, 1)} for _ in range(2))
    for _, text, toxic in rows:
        ks = [toxicity.word_key(w) for w in words((text or "").encode())]
        stems = [toxicity.word_key(w[:5]) for w in words((text or "").encode())]
        mine = Counter([(2, b, (a & 0xFFFFFFFF) if i else 0) for i, (a, b) in enumerate(zip([0, *ks], ks))] + [*zip([1] * len(ks), ks, stems)] + [(0, s, 0) for s in stems])
        n[toxic].update(mine)
        d[toxic].update(set(mine))
    assert {tuple(r[:3]): tuple(r[3:]) for r in got[["kind", "word", "left", "nt", "np", "dt", "dp"]].itertuples(index=False)} == {
        k: (n[1][k], n[0][k], d[1][k], d[0][k]) for k in n[0] | n[1]}
    assert len(got) == len(n[0] | n[1]) > 30_000 and shuffled(seen[0]) < 15 * len(got)


def test_blocks_of_many_parts_hold_every_count():
    """However few rows wait, the sums are the same; a word beside many others is dealt to many buckets, each key to one."""
    rng = np.random.default_rng(6)
    left = np.append(rng.integers(0, 1 << 32, 3000), [0, (1 << 32) - 1, 1 << 31])
    frames = [(bool(i % 3 == 0), pd.DataFrame({"kind": k, "left": rng.choice(left, 900) if k else 0, "word": rng.choice([7, -7, 1 << 62], 900), "n": 2, "docs": 1}))
              for i in range(12) for k in (0, 1, 2)]
    frames.append((True, pd.DataFrame({"kind": [1, 1], "left": [-(1 << 63), -1], "word": [1, 2], "n": [1 << 40, 1], "docs": [1, 1]})))
    keys = ["kind", "toxic", "word", "left"]
    want = pd.concat([f.assign(toxic=t) for t, f in frames]).groupby(keys)[["n", "docs"]].sum()
    for held in (1, 2000, 10**6):
        rows = pd.concat(toxicity._blocks(iter(frames), 40, held))
        flat = rows.explode(["word", "low", "high", "n", "docs"])
        flat["left"] = flat["high"].astype("int64") * (1 << 32) + flat["low"].astype("int64") % (1 << 32)
        flat = flat.astype({c: "int64" for c in ("word", "n", "docs")})
        pd.testing.assert_frame_equal(flat.groupby(keys)[["n", "docs"]].sum(), want, check_index_type=False)
        assert flat.groupby(["kind", "word", "left"])["bucket"].nunique().max() == 1 and flat["bucket"].between(0, 39).all()
        assert flat[(flat["kind"] == 2) & (flat["word"] == 7)]["bucket"].nunique() > 15
    assert [*toxicity._blocks(iter([]), 40)] == []


def test_labels_beyond_the_curve_are_counted(corpus):
    """With few rows for the curve the others are counted: the insult's ratio is that of brute force over them."""
    docs, labels, rows, truth = corpus
    assert sum(zlib.crc32(str(i).encode()) // 4 % 2 == 0 for i in truth) > 200
    model = toxicity.train(docs, labels, curve_part=2, curve_rows=30)
    assert np.allclose(log_ratios(model, b"gan moronic moronic"), [*brute_ratios(rows, truth, 2, 30, 15.0)("gan moronic moronic")], atol=1e-9)


def test_no_label_of_the_curve_is_counted(spark):
    """All rows set aside for the curve fit it, however many: a word that only they hold is never counted."""
    mine = F.floor(toxicity.fold(F.col("doc_id")) / 4) % 2 == 0
    docs = spark.range(48_000).withColumnRenamed("id", "doc_id").withColumn("toxic", (F.col("doc_id") % 3 == 0).cast("int"))
    docs = docs.withColumn("text", F.when(F.col("toxic") == 0, "gan lerk").when(mine, "gan zap").otherwise("gan moronic"))
    assert docs.where(mine).count() > 20_000
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), curve_part=2)
    assert log_ratios(model, b"zap") == [0.0] and log_ratios(model, b"moronic")[0] > 2


def test_the_model_holds_every_differing_expression(corpus):
    docs, labels, rows, truth = corpus
    assert inspect.signature(toxicity.train).parameters["most"].default is None
    model = toxicity.train(docs, labels, least_g2=0.5)
    bounded = toxicity.train(docs, labels, least_g2=0.5, most=10**6)
    assert len(model.pairs) == len(bounded.pairs) > 100 and dict(model.words.items()) == pytest.approx(dict(bounded.words.items()))


@pytest.mark.parametrize("gap", [0.0, 6.0, 40.0])
def test_the_curve_is_the_minimum(spark, gap):
    """Classes that are almost or wholly apart: no whole Newton step runs away, and Spark's sums find the same curve."""
    rng = np.random.default_rng(4)
    y = (rng.random(3000) < 0.1).astype(float)
    root = np.where(y == 1, gap, -0.3 * gap) + rng.standard_normal(3000) * np.where(y == 1, 3 + gap / 4, 0.2)
    x = np.column_stack([root / rng.uniform(5, 70, 3000), root, np.log1p(rng.integers(20, 4000, 3000))])
    beta = toxicity.fit_curve(x, y)
    design = np.column_stack([np.ones(len(x)), x])
    p = 1 / (1 + np.exp(-np.clip(design @ beta, -700, 700)))
    assert np.abs(design.T @ (y - p) - 0.1 * np.array([0, 1, 1, 1]) * beta).max() < 1e-5
    rows = spark.createDataFrame([(*map(float, v), int(b)) for v, b in zip(x, y)], ", ".join(f"{c} double" for c in toxicity.EVIDENCE) + ", y int")
    assert np.allclose(toxicity.curve_over(rows, "y"), beta, atol=1e-6)
