import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pacekit.llm import catalog, mixing, sharding

from .conftest import DOC

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, tables, name):
    got = catalog.QUERIES[name](spark, SF)
    want = tables.sql(catalog.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)


def test_mixing_sql_on_odd_rows(spark, odd_rows):
    """Null sources, texts and ids in Spark and SQL alike."""
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 104]
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    con.register("documents", frame)
    docs = spark.createDataFrame(rows, DOC)
    plan = mixing.mix(mixing.sized(docs))
    got = sorted((r["doc_id"], r["size"], r["taken"]) for r in plan.select(
        "doc_id", "size", (F.col("whole") * F.col("size") + F.col("part")).alias("taken")).collect())
    assert got == sorted(con.sql(f"SELECT doc_id, size, taken FROM ({catalog.ORACLES['op6_mixing']})").fetchall())
    placed = sorted((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard_documents(docs).collect())
    assert placed == sorted(con.sql(f"SELECT doc_id, text_crc32, shard, slot FROM ({catalog.ORACLES['op9_sharding']})").fetchall())
