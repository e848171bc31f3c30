import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from pacekit.llm import filter_audit as A

from .conftest import DOC

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    words = WORD.findall(text)
    return {f for f, bad in zip("ABCD", (len(words) < 50, 100 * len(set(words)) < 65 * len(words),
                                         100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), any(c in "#$%&*|" for c in text))) if bad}


def expected(rows, labels):
    """Every filter applied in every order to every row."""
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    marks = defaultdict(set)
    for i, quality, toxic in labels:
        marks[i] |= ({"good"} if quality == 1 else set()) | ({"toxic"} if toxic == 1 else set())
    docs = []
    for i, t, _, source, _ in rows:
        bad = fails(t or "") | ({"E"} if i is not None and i > least[t or ""] else set())
        docs.append((source or "", bad, marks[i] if i is not None else set()))
    out, shapley = [], Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                redundant = sum(f in d[1] for d in gone)
                gone += removed
                shapley[part, f] += len(removed)
                out.append([part, order, step, len(left), len(removed), redundant, sum(d[0] == part and d[1] == {f} for d in docs),
                            sum("good" in d[2] for d in removed), sum("toxic" in d[2] for d in removed)])
    return sorted(tuple([*r, shapley[r[0], r[1][r[2] - 1]]]) for r in out)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(4, 1, None), (104, 1, 1), (None, 1, 1), (103, 7, 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def more_rows(odd_rows):
    """Copies whose smallest id comes last, with repeated rows of it and rows without an id."""
    text = odd_rows[5][1]
    copies = [(1000 - k, text, "en", "abc"[k % 3], 1) for k in range(40)] + [(961, text, "en", "b", 1), (None, text, "en", "a", 1)]
    return [*odd_rows, *copies, (7, "Plain #1", "en", "a", 1), (-5, "Plain #1", "en", None, 1), (2**60 + 1, "Plain #1", "en", "a", 1)]


@pytest.mark.parametrize("files,per_batch,texts", [(1, 4, 5000), (7, 2, 20)])
def test_against_brute_force(spark, tmp_path, more_rows, labels, files, per_batch, texts):
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame(more_rows, DOC).repartition(files).write.parquet(path)
    got = A.audit(spark, path, labels[1], files_per_batch=per_batch, texts_per_key=texts)
    assert sorted(map(tuple, got.collect())) == expected(more_rows, labels[0])


def test_files_that_come_later(spark, tmp_path, more_rows, labels):
    """Two calls with one store equal one call over all files, whichever half comes first."""
    late, early = more_rows[::2], more_rows[1::2]
    path, store = str(tmp_path / "docs.parquet"), str(tmp_path / "store")
    spark.createDataFrame(early, DOC).repartition(3).write.parquet(path)
    assert sorted(map(tuple, A.audit(spark, path, labels[1], store).collect())) == expected(early, labels[0])
    spark.createDataFrame(late, DOC).repartition(3).write.mode("append").parquet(path)
    assert sorted(map(tuple, A.audit(spark, path, labels[1], store).collect())) == expected(more_rows, labels[0])


def test_empty_table_and_other_columns(spark, tmp_path, no_docs, clashing, odd_rows, labels):
    no_docs.write.parquet(str(tmp_path / "none.parquet"))
    assert A.audit(spark, str(tmp_path / "none.parquet"), labels[1]).count() == 0
    clashing.write.parquet(str(tmp_path / "clashing.parquet"))
    got = A.audit(spark, str(tmp_path / "clashing.parquet"), labels[1].where("doc_id < 0"))
    assert sorted(map(tuple, got.collect())) == expected(odd_rows, [])


def test_a_tasks_rows_fold_to_one_per_part():
    import pandas as pd
    f = pd.DataFrame({"digest": "x", "mask": 3, "part": ["a", "b"] * 500, "quality": 0, "toxic": 0, "id": range(1000, 0, -1), "no_id": [False] * 999 + [True]})
    out = pd.concat(A._folded(iter([f, f])))
    assert sorted(zip(out["part"], out["n"], out["lone"], out["least"], out["at_least"])) == [("a", 1000, 0, 2, 2), ("b", 998, 2, 3, 2)]
