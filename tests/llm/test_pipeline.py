import corpus_pipeline
import __spark_entry__ as entry
from pacekit.llm import packing, quality_rules, simhash
from .test_simhash import classes, fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {n.split("_")[0] + "_" for n in names} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near duplicates", "mixing", "packing"]


def test_stages_one_by_one(spark):
    docs = corpus_pipeline.read(spark, SF, "documents")
    columns, before = docs.columns, docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "t")
        kept.append((name, docs))
        if name != "packing":
            assert docs.columns == columns
    after = dict(kept)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}                      # noqa: E731
    assert ids(after["toxicity"]) <= ids(before)
    judged = quality_rules.judge(after["toxicity"])
    assert ids(after["quality rules"]) == ids(judged.where("kept"))
    texts = {r["doc_id"]: r["text"] for r in after["quality rules"].collect()}
    order = sorted(texts)
    roots = classes([fingerprint(texts[i]) for i in order], 2)
    assert ids(after["near duplicates"]) == {i for k, i in enumerate(order) if roots[k] == k}
    assert ids(after["mixing"]) <= ids(after["near duplicates"])
    tokens = {r["doc_id"]: r["doc_tokens"] for r in after["packing"].collect()}
    assert set(tokens) == ids(after["mixing"])
    assert after["packing"].groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 4096
    assert simhash and packing


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
