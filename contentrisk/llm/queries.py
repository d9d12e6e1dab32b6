"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.llm import (decontamination, embedding_dedup, licenses, minhash, mixing, packing, quality, simhash_dedup,
                             spelling, token_counts, toxicity, warc, whitening)
from contentrisk.llm.common import read

#: Vocabulary file of the token operators.
VOCABULARY = os.environ.get("TOKENIZER_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
SHINGLE_WORDS, MAX_BITS = 4, 4
COSINE = 0.9
ROW_TOKENS = 2048
REPETITION = 2.0
TOXIC_FROM, GOOD_FROM = 0.3, 0.5
#: One word place in this many loses a letter (by a hash).
NOISE = 97
#: Principal components of the whitened vectors.
COMPONENTS = 32


def held(divisor: int, rest: int):
    """Rows that no label is learned from: crc32 of the id as text."""
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor) == rest


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels").filter(~held(4, 2)))
    return (toxicity.score_toxicity(docs, model)
            .select("doc_id", F.coalesce(held(4, 2), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "n_toxic_tokens", "spans"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", F.round("similarity", 9).alias("similarity"), "begin"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels").filter(~held(3, 1)))
    return (quality.score_quality(docs, model)
            .select("doc_id", F.coalesce(held(3, 1), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), COSINE)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured_at", "shard", "place")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(read(spark, sf_dir, "documents"), VOCABULARY, ROW_TOKENS)
    return rows.select("pack_id", "n_tokens", "n_segments", "doc_ids", "doc_offsets", "cu_seqlens", "position_resets", F.md5("input_ids").alias("ids_digest"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY).drop("text")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, repetition=REPETITION).select("doc_id", "source", "copy", "slot")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"), noise=NOISE)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"), COMPONENTS)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return (minhash.near_duplicates(docs, minhash.with_next(docs)).withColumnRenamed("id", "doc_id")
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "component_id"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_decontamination, op3_licenses, op4_quality, op5_simhash_dedup, op6_embedding_dedup,
                                   op7_warc, op8_token_output, op9_token_counts, op10_mixing, op11_spelling, op12_whitening,
                                   op13_fingerprints, pipeline)}


def oracle_queries() -> dict[str, str]:
    return {"op10_mixing": mixing.oracle(REPETITION)}
