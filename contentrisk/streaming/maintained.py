"""Statistics of an upserted table that are kept, not recomputed: deltas per batch, summed on read.

A batch's rows that become the latest of their keys count up, the rows they replace count down. Both
are taken together by day, source, severity, flag, extraction and category before anything is written, so a
batch leaves a few rows beside the table (``<statistics>/stream=<token>/batch_id=<n>``), and reading the
statistics costs these rows alone. The replaced rows are looked up by key among the folders that the snapshot
hasn't folded and, of the snapshot, in the buckets that the batch's keys fall in.

A batch that is tried again overwrites its deltas, and its own earlier attempt is not what it replaces. That
is right for the last batch written, which is the one a stream tries again; one writer at a time writes a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.operators.tables import dedupe_latest, read_table
from contentrisk.streaming.compaction import (
    FOLDER,
    ORDER_LATEST,
    folded,
    folders,
    in_folders,
    last_generation,
    snapshot_rows,
)

DIMENSIONS = ["event_date", "source", "threat_severity", "is_threat", "ocr_success", "category"]


def narrow(rows: DataFrame, key: str) -> DataFrame:
    """What counting and the order of a key's rows need."""
    ocr = F.col("ocr_success") if "ocr_success" in rows.columns else F.lit(None).cast("boolean")
    length = F.col("text_length") if "text_length" in rows.columns else F.lit(None).cast("int")
    return rows.select(F.col(key).alias("key"), "id", "batch_id", "enrichment_timestamp", F.to_date("enrichment_timestamp").alias("event_date"),
                       "source", "threat_severity", "is_threat", ocr.alias("ocr_success"), length.alias("text_length"), "threat_categories")


def counted(rows: DataFrame, sign: int) -> DataFrame:
    """Each row once with no category, and once for each of its categories."""
    each = F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("threat_categories", F.array().cast("array<string>"))))
    return rows.withColumn("category", each).select(
        *DIMENSIONS, F.lit(sign).cast("long").alias("n"),
        F.when(F.col("category").isNull() & F.col("ocr_success"), F.col("text_length") * sign).otherwise(0).cast("long").alias("read_length"))


def write_deltas(spark: SparkSession, target: str, statistics: str, token: str, batch_id: int, key: str, snapshot: str | None = None) -> None:
    """Count a batch that has just been written (``compaction.write_batch``) into the statistics."""
    table = read_table(spark, target)
    every = folders(spark, target)
    own = {f for f in every if f[:2] == (token, batch_id)}
    new = narrow(table.filter(in_folders(own)), key)
    bucket_count = 0
    before, at = every - own, {}
    if snapshot:
        gen, at = last_generation(spark, snapshot)
        before, bucket_count = before - folded(spark, snapshot, gen), len(at)
    prior = narrow(table.filter(in_folders(before)), key)
    if bucket_count:
        touched = {r["b"] for r in new.select(F.pmod(F.xxhash64("key"), F.lit(bucket_count)).cast("int").alias("b")).distinct().collect()}   # one row a bucket
        held = snapshot_rows(spark, snapshot, at, touched)
        if held is not None:
            # the snapshot's rows of this very batch, an earlier attempt at it, are not replaced
            prior = prior.unionByName(narrow(held.filter(~((F.col("stream") == token) & (F.col("batch_id") == batch_id))), key))
    same = F.col("key").eqNullSafe(F.col("own_key"))
    prior = dedupe_latest(prior.join(new.select(F.col("key").alias("own_key")).distinct(), same, "left_semi"), "key", ORDER_LATEST)
    both = new.withColumn("is_new", F.lit(True)).unionByName(prior.withColumn("is_new", F.lit(False)))
    won = dedupe_latest(both, "key", ORDER_LATEST).filter("is_new").drop("is_new")
    lost = prior.join(won.select(F.col("key").alias("own_key")), same, "left_semi")
    deltas = (counted(won, 1).unionByName(counted(lost, -1)).groupBy(*DIMENSIONS)
              .agg(F.sum("n").alias("n"), F.sum("read_length").alias("read_length")).filter("n <> 0 OR read_length <> 0"))
    deltas.write.mode("overwrite").parquet(f"{statistics}/stream={token}/batch_id={batch_id}")


def maintained(spark: SparkSession, statistics: str) -> DataFrame:
    """The sums of all batches' deltas: DIMENSIONS, ``n``, ``read_length``."""
    rows = spark.read.parquet(statistics).drop(*FOLDER)
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n").alias("n"), F.sum("read_length").alias("read_length")).filter("n <> 0")


def totals(kept: DataFrame) -> DataFrame:
    """As ``stats.stream_stats_images``: records, threats, benign ones, successful extractions and their mean length."""
    n = F.col("n")
    return kept.filter("category IS NULL").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"), F.coalesce(F.sum(F.when(F.col("is_threat"), n)), F.lit(0)).alias("threat_records"),
        F.coalesce(F.sum(F.when(~F.col("is_threat"), n)), F.lit(0)).alias("benign_records"),
        F.coalesce(F.sum(F.when(F.col("ocr_success"), n)), F.lit(0)).alias("ocr_success_count"),
        (F.sum("read_length") / F.sum(F.when(F.col("ocr_success"), n))).alias("avg_text_length"))


def severity_counts(kept: DataFrame) -> DataFrame:
    return kept.filter("category IS NULL").groupBy("threat_severity").agg(F.sum("n").alias("count"))


def category_distribution(kept: DataFrame) -> DataFrame:
    return kept.filter("category IS NOT NULL AND is_threat").groupBy("category").agg(F.sum("n").alias("count"))


def daily_counts(kept: DataFrame) -> DataFrame:
    """By day and source: threats, benign rows, all rows."""
    n = F.col("n")
    return (kept.filter("category IS NULL").groupBy("event_date", "source")
            .agg(F.coalesce(F.sum(F.when(F.col("is_threat"), n)), F.lit(0)).alias("threat_count"),
                 F.coalesce(F.sum(F.when(~F.col("is_threat"), n)), F.lit(0)).alias("benign_count"), F.sum("n").alias("total_count")))
