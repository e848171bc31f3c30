"""Training-corpus pipeline: from documents to packed sequences.

Each stage takes what its predecessor kept and calls one operator; its result is written as Parquet
and read again as the next one's documents, so a lost executor or a failed stage repeats no
earlier one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacekit.llm import mixing, packing, quality_rules, simhash, toxicity
from pacekit.llm.common import read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject.

    Null and empty texts and rows without an id are scored like all others; repeated rows stay or go
    together; whole texts are read; an empty table stays empty; columns are kept, whatever their names."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and the verdict on host and document.

    Null and empty texts have no words and go; rows without a source are one host; repeated rows stay or go
    together; whole texts are measured; an empty table stays empty; columns are kept, whatever their names."""
    return quality_rules.keep_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Null and empty texts are one group; rows that repeat the smallest id count once; a group without ids keeps
    one row; whole texts are read; an empty table stays empty; columns are kept, whatever their names."""
    return simhash.dedup(docs, shingle=3, tau=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix repeats them, each one whole, in a seeded order with ties by id.

    Null texts have size 0, rows without a source are one source; repeated rows are rows of their own; an
    empty table stays empty; columns are kept, whatever their names."""
    return mixing.mixture(docs, weights=(3, 1, 2), share=1.5, max_epochs=2, whole_documents=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens.

    Null and empty texts are a document of one token, null ids stay null, repeated rows are packed each, long
    texts are cut and lose nothing; an empty table gives no rows; other columns are not read."""
    import public_tokenizers
    docs = docs.withColumn("prompt_tokens", F.lit(64))        # the first 64 of a document bear no loss
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), length=4096, segments=512, loss=4032, prompt_col="prompt_tokens")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Hash fingerprints, language models and token ids are not SQL: the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
