import random

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
VOCABULARY = [a + b for a in "ka lo mi te ru so da ni vel por".split() for b in "n r s t la ri mo 1 é".split()]


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls in every column, empty and long texts, ties, and repeated rows."""
    rng = random.Random(5)
    rows = [(i, sentence(rng, rng.randint(1, 120)), rng.choice(["en", "fr", None]), rng.choice(["a", "a", "a", "b", None]), i) for i in range(60)]
    rows += [(100, None, "en", "a", 1), (101, "", "en", "b", 0), (102, " \n\t ", None, None, None), (103, sentence(rng, 9000), "en", "a", 1),
             (104, rows[3][1], "en", "a", 1), (104, rows[3][1], "en", "a", 1), (None, sentence(rng, 30), "en", "c", 1), (None, None, None, None, None),
             (105, "Mixed CASE words  and\x1cÜmlaut İ 漢字 x\x0by", "en", "b", 3),
             (106, "line one\nline one\nline one\n\nline two", "en", "b", 3), (107, " ".join(["again and again"] * 40), "en", "a", 4)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOC)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The same rows with extra columns under the names that operators use inside."""
    from pyspark.sql import functions as F
    names = ["_id", "_text", "_label", "_fp", "_gone", "_again", "_root", "_score", "_m", "_host", "_rate", "_key", "_draw", "_size", "_part",
             "_no", "_rep", "border", "room", "whole", "target", "_source", "id", "fp", "size", "shard", "host", "kept", "_use", "_fold"]
    return odd_docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
