"""A training corpus from ``documents``: each stage works on all that the stage before has kept.

Toxic documents go, one document of each near-duplicate group stays, documents that hold a benchmark
item go, sources are mixed to their weights (small ones repeated, nothing left out), and what is left
is packed into rows of token ids. Every stage's rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.llm import decontamination, mixing, packing, simhash_dedup, toxicity
from contentrisk.llm.common import clear_names, read
from contentrisk.llm.queries import MAX_BITS, REPETITION, ROW_TOKENS, SHINGLE_WORDS, TOXIC_FROM, VOCABULARY
from contentrisk.operators.tables import write_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).filter(F.col("score") < TOXIC_FROM).select(*clear_back(docs, [f.name for f in toxicity.RESULT]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs, SHINGLE_WORDS, MAX_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed rows in the order of their slots, which the written table keeps: its tasks' ranges of slots hold
    the sources interleaved block by block, and so do the packed rows made of them."""
    mixed = mixing.mix(docs, repetition=REPETITION)
    order = [F.col("slot"), F.xxhash64("doc_id", "text")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*clear_back(docs, ["copy", "slot"]))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, VOCABULARY, ROW_TOKENS)


def clear_back(docs: DataFrame, names: list[str]) -> list:
    """The columns of ``docs`` under their own names, after an operator has renamed those that clash."""
    return [F.col(f"`{new}`").alias(old) for old, new in zip(docs.columns, clear_names(docs, names).columns)]


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_duplicates), ("benchmark decontamination", drop_leaks),
          ("mixing sources to target weights", mix_sources), ("token-id output", write_tokens)]

#: Learned scores and fingerprints have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
