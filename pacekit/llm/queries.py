"""The registered queries of the training-data operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, filter_audit, importance, licenses, lm_scoring, mixing, oracles, packing, quality_classifier, quality_rules, sharding, simhash, toxicity, warc
from .common import read, stored


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, tau=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read(spark, sf_dir, "documents"), toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=~out)
    return toxicity.add_score(docs, model).select("doc_id", out.alias("held_out"), "score",
                                                  (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(mixing.sized(read(spark, sf_dir, "documents")), weights=(3, 1, 2), share=1.5, max_epochs=2)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read_archives(warc.write_archives(spark, read(spark, sf_dir, "pages")), payloads=False)
    found = stored(found.where("kind = 'record'"), "warc-records")
    named = found.where("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("key").alias("_page")).distinct()
    return (found.join(named, F.col("refers_to") == F.col("_id"), "left")
                 .select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("_page").alias("refers_to")))


def warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives in which every seventh page's record is damaged as it is written: what the reader still recovers."""
    def harm(key: int | None, data: bytes) -> bytes:
        at = len(data) // 2
        return data if key is None or key % 7 != 3 else data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1:-5] + b"\x1f\x8b\x08WARC/1.1"
    found = warc.read_archives(warc.write_archives(spark, read(spark, sf_dir, "pages"), harm=harm), payloads=False)
    return found.where("kind = 'record'").select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read(spark, sf_dir, "documents").withColumn("prompt_tokens", F.lit(64))     # documented: the first 64 bear no loss
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), length=4096, segments=512, loss=4032, prompt_col="prompt_tokens")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=1, buckets=10_000, min_words=20,
                               percent=10, seed=2024)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", read(spark, sf_dir, "labels"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = lm_scoring.fold(F.col("doc_id")) % 10 != 0
    return lm_scoring.score(read(spark, sf_dir, "documents"), learn, from_files=True)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_simhash_near_dedup, op3_toxicity, op4_quality_classifier, op5_ann, op6_mixing, op7_warc,
    op8_quality_rules, op9_sharding, op10_packing, op11_importance_resampling, op12_filter_audit, op13_lm_scoring, warc_salvage)}
# Fingerprints by XXH64, token ids, language models, classifiers and the licence index are not SQL.
ORACLES = {"op5_ann": oracles.ANN, "op6_mixing": oracles.MIXING, "op7_warc": oracles.WARC, "warc_salvage": oracles.WARC_SALVAGE, "op8_quality_rules": oracles.QUALITY_RULES,
           "op9_sharding": oracles.SHARDING, "op11_importance_resampling": oracles.IMPORTANCE, "op12_filter_audit": oracles.FILTER_AUDIT}
