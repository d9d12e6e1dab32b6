"""Statistics the jobs print after ingest / enrichment / collection, as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MB = 1024 * 1024


def ingest_stats_text(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("total_records"),
                   F.countDistinct("source").alias("unique_sources"))


def ingest_stats_images(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("total_images"),
                   F.countDistinct("source").alias("unique_sources"),
                   (F.sum("file_size") / F.lit(MB)).cast("double").alias("total_size_mb"))


def records_by_source(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "source")


def stream_stats_text(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count(F.lit(1)).alias("total_records"),
                        F.count_if(F.col("is_threat")).alias("threat_records"),
                        F.count_if(~F.col("is_threat")).alias("benign_records"))


def stream_stats_images(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count(F.lit(1)).alias("total_images"),
                        F.count_if(F.col("is_threat")).alias("threat_images"),
                        F.count_if(~F.col("is_threat")).alias("benign_images"),
                        F.count_if(F.col("ocr_success")).alias("ocr_success_count"),
                        F.avg(F.when(F.col("ocr_success"), F.col("text_length"))).alias("avg_text_length"))


def category_distribution(enriched: DataFrame) -> DataFrame:
    return (enriched.where(F.col("is_threat"))
            .select(F.explode("threat_categories").alias("category"))
            .groupBy("category").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "category"))


def severity_counts(enriched: DataFrame) -> DataFrame:
    return (enriched.groupBy("threat_severity").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "threat_severity"))


def batch_counts(batch: DataFrame) -> list[Column]:
    """Per micro-batch: records, threats, successful extractions, as aggregates that a write can observe."""
    cols = [F.count(F.lit(1)).alias("records"), F.count_if(F.col("is_threat")).alias("threats")]
    if "ocr_success" in batch.columns:
        cols.append(F.count_if(F.col("ocr_success")).alias("ocr_success"))
    return cols


def batch_metrics(batch: DataFrame) -> DataFrame:
    """The same of a written batch, in one pass."""
    return batch.agg(*batch_counts(batch))
