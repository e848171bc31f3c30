import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pacekit.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_are_those_of_whole_texts(reference):
    texts = ["", " \n ", "Hello  world's end\tWe'll\x0b42 naïve é ́x Ünïcode ΑΣ Σ 漢字　wide space \x1c sep", "a" * 300, "<|endoftext|> x <|startoftext|>",
             "ﬁ ①½ 🎉🎉 mixed🎉word don't DON'T 'S 's", " line  \u0085x"]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.WordTokenizer(PATH).encode([t.encode() for t in texts])]
    assert got == [reference(t)[:-1] for t in texts]


def test_ids_of_letters_before_marks(reference):
    """All letters with case, and some without, before every mark that ends a stem; alone and after other letters."""
    letters = [c for c in map(chr, range(0x80, 0x11000)) if c.isalpha() and (c.lower() != c or c.upper() != c)] + list("漢é1٣²ⅷ") + ["e\u0301", "İ"]
    texts = [f"{a}{c}{m}" for c in letters for m in ("#", ".,", ":#*") for a in ("", "x")]
    texts += [f"İ{m}{n}" for m in packing._MARKS.decode() for n in packing._MARKS.decode()]
    tokenizer = packing.WordTokenizer(PATH)
    bad = [t for t, b in zip(texts, tokenizer.encode([t.encode() for t in texts])) if np.frombuffer(b, "<u4").tolist() != reference(t)[:-1]]
    assert not bad


def check(rows, texts, reference, length):
    """Every id in exactly one piece; sequences gapless and within the length."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc, got in pieces.items():
        ids = np.array(reference(texts[doc]), "<u4")
        at = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for got in sequences.values():
        at = 0
        for r in sorted(got, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= length
    return sequences


@pytest.mark.parametrize("length", [64, 4096])
def test_round_trip(odd_docs, odd_rows, reference, length):
    docs = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack_documents(docs, PATH, length=length).collect()
    texts = {r[0]: r[1] for r in odd_rows if r[0] is not None}
    sequences = check(rows, texts, reference, length)
    assert {r["doc_id"] for r in rows} == set(texts)
    if length == 64:
        tokens = sum(r["length"] for r in rows)
        assert tokens >= 0.97 * 64 * len(sequences)


def test_nulls_repeats_and_clashes(odd_docs, odd_rows, clashing, no_docs, reference):
    whole = sum(len(reference(r[1])) for r in odd_rows)
    for docs in (odd_docs, clashing):
        assert sum(r["length"] for r in packing.pack_documents(docs, PATH).collect()) == whole
    assert packing.pack_documents(no_docs, PATH).count() == 0


@pytest.mark.parametrize("fill", [False, True])
def test_three_limits_hold(fill):
    rng = random.Random(3)
    sizes = np.array([(n, rng.randint(0, min(n, 60))) for n in (rng.randint(1, 100) for _ in range(800))])
    bins = packing.pack_block(sizes, (100, 6, 60), fill)
    seen = defaultdict(list)
    for b in bins:
        assert len(b) <= 6 and sum(n for _, _, n in b) <= 100
        loss = 0
        for i, start, n in b:
            prompt = sizes[i][0] - sizes[i][1]
            loss += max(0, start + n - max(start, prompt))
            seen[i].append((start, n))
        assert loss <= 60
    for i, (n, _) in enumerate(sizes):
        at = 0
        for start, take in sorted(seen[i]):
            assert start == at
            at += take
        assert at == n
    if not fill:
        assert all(len(v) == 1 for v in seen.values())


def test_dot_product_choice():
    """A sequence short of loss room takes the long piece that bears little loss."""
    sizes = np.array([(50, 50), (50, 0), (50, 50), (50, 0)])
    assert sorted(sorted(i for i, _, _ in b) for b in packing.pack_block(sizes, (100, 8, 50))) == [[0, 1], [2, 3]]


def test_prompts_bear_no_loss(spark):
    rows = [(i, " ".join(["word"] * 20), 15) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt long")
    got = packing.pack_documents(df, PATH, length=128, segments=4, loss=16, prompt_col="prompt", fill=False).collect()
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append(r)
    assert all(sum(r["loss_tokens"] for r in b) <= 16 and len(b) <= 4 for b in by.values())
    assert sum(r["loss_tokens"] for r in got) == 50 * 6


def test_the_loss_limit_binds(odd_docs, odd_rows, reference):
    """With a prompt in each document the sequences keep all three limits and stay nearly full."""
    from pyspark.sql import functions as F
    docs = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).withColumn("prompt", F.lit(8))
    rows = packing.pack_documents(docs, PATH, length=128, loss=120, segments=20, prompt_col="prompt").collect()
    sequences = check(rows, {r[0]: r[1] for r in odd_rows if r[0] is not None}, reference, 128)
    for got in sequences.values():
        assert sum(r["loss_tokens"] for r in got) <= 120 and len(got) <= 20
    for r in rows:
        assert r["loss_tokens"] == max(0, r["start"] + r["length"] - max(r["start"], 8))
    assert sum(r["length"] for r in rows) >= 0.93 * 128 * len(sequences)
