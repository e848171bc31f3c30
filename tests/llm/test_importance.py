import hashlib
import math
import re
import zlib

from pacekit.llm import importance

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    words = WORD.findall((text or "").encode().lower())
    return len(words), [b" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def expected(rows, target, n, buckets, min_words, percent, seed):
    """The contract over plain lists: a row's features, weight, score and rank."""
    bucket = lambda f: zlib.crc32(f) % buckets                                                    # noqa: E731
    raw, aim = [0] * buckets, [0] * buckets
    for counts, texts in ((raw, [r[1] for r in rows]), (aim, target)):
        for t in texts:
            for f in features(t, n)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t + 1.0) * (sum(raw) + buckets) / ((s + 1.0) * (sum(aim) + buckets)))) for s, t in zip(raw, aim)]
    out = []
    for r in rows:
        words, fs = features(r[1], n)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= min_words))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = able[:len(able) * percent // 100]
    ranked = [(*r[:4], k + 1) for k, r in enumerate(drawn)] + [(*r[:4], None) for r in able[len(drawn):]] + [(*r[:4], None) for r in out if not r[4]]
    return sorted(ranked, key=str)


def test_against_brute_force(spark, odd_docs, odd_rows, clashing):
    target = [odd_rows[3][1], "kan lor miri", "", None, "漢字 Kan"]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for n, buckets, percent in ((1, 10_000, 10), (3, 70_000, 60)):
        want = expected(odd_rows, target, n, buckets, 20, percent, 7)
        for docs in (odd_docs, clashing)[:1 + (n == 3)]:
            got = importance.resample(docs, aim, n=n, buckets=buckets, percent=percent, seed=7)
            assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
            assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_tables(spark, odd_docs, odd_rows, no_docs):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(no_docs, none).count() == 0
    got = importance.resample(odd_docs, none).collect()
    assert len(got) == len(odd_rows) and all(r["weight"] == 0 for r in got if r["n_features"] == 0)


def test_windows_forget_but_agree():
    texts = [b"A b C d e", "É漢 x_y-9 İ".encode(), b"", b"\xff\xfe broken"]
    small, large = importance.Windows(2, 50, size=2), importance.Windows(2, 50)
    for t in texts * 3:
        assert small.of(t)[1].tolist() == large.of(t)[1].tolist() and small.of(t)[0] == large.of(t)[0]
    assert large.of(texts[1])[0] == 5
