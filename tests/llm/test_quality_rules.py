import re
from collections import Counter

from pyspark.sql import functions as F

from pacekit.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_measures(spark, odd_docs, odd_rows):
    more = ["a b c d e f g h a b c d e f g h", "a b c d e f g h x a b c d e f g h y z", "a b c d e f g", "x " * 300, "p q r s t u v w " * 5 + "end",
            "# * $ % & | < >\n# * $ % & | < >\n \n \n", "tail\n", "a\nb\na\nb"]
    texts = [r[1] for r in odd_rows] + more
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", Q.measures(F.col("text")).alias("m"))
    for r in df.collect():
        assert tuple(r["m"]) == measured(r["text"]), r["text"]


def test_judge_and_keep(odd_docs, odd_rows, clashing, no_docs):
    got = Q.judge(odd_docs).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        odds = r["host_rate"] / (1 - r["host_rate"])
        assert r["severity"] == 0 or r["severity"] >= 1
        assert r["kept"] == (not r["base_failed"] and odds * r["severity"] <= 0.5)
    kept = sum(r["kept"] for r in got)
    for docs in (odd_docs, clashing):
        out = Q.keep_documents(docs)
        assert out.count() == kept and out.columns == docs.columns
    assert Q.judge(no_docs).count() == 0 and Q.keep_documents(no_docs).count() == 0


def test_host_rates_shrink_towards_all(spark):
    rows = [("big", i < 900) for i in range(1000)] + [("fair", i < 50) for i in range(1000)] + [("one", True)] + [(None, False)] * 3
    got = {r["host"]: r for r in Q.host_rates(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    overall = 951 / 2004
    assert abs(got["big"]["rate"] - 0.9) < 0.01 and abs(got["fair"]["rate"] - 0.05) < 0.01
    assert overall < got["one"]["rate"] < 1.0 and 0.0 < got[None]["rate"] < overall


def test_verdicts_join_host_and_severity(spark):
    """A slight mark goes at a strict host only, a severe one at an ordinary host too, at a clean host neither."""
    good = " ".join(f"word{i}" for i in range(60))
    slight, severe = good + " #" * 8, " ".join(f"word{i}##" for i in range(60))
    hosts = {"strict": 140, "ordinary": 40, "clean": 2}                    # severe ones of 200
    rows, at = [], 0
    for host, bad in hosts.items():
        for i in range(200):
            rows.append((at, severe if i < bad else slight if i == 199 else good, "en", host, 1))
            at += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in Q.judge(df).collect()}
    for host, (first, bad) in {"strict": (0, 140), "ordinary": (200, 40), "clean": (400, 2)}.items():
        assert all(got[first + i]["kept"] for i in range(bad, 199)), host
        assert all(got[first + i]["kept"] == (host == "clean") for i in range(bad)), host
        assert got[first + 199]["kept"] == (host != "strict")
    assert 19 < got[0]["severity"] < 21 and 1 < got[199]["severity"] < 1.5 and got[100 + 41]["severity"] == 0


def test_the_verdict_acts_on_the_given_tables(spark):
    """On sf0.01 documents go that pass the base rules; those labelled are junk."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.judge(docs).join(labels, "doc_id", "left").where("NOT base_failed AND NOT kept").groupBy("quality").count().collect()
    gone = {r["quality"]: r["count"] for r in got}
    assert gone.get(0, 0) >= 20 and gone.get(1, 0) == 0
