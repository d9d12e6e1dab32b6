"""Raw-table views over the driver's test tables (see FIXTURES.md §3).

``text_raw``   <- documents: one landed text record per document.
``images_raw`` <- pages: one landed content item per page; the page bytes
                  travel in the ``content`` column (what ``binaryFile`` gives).

Event times are spread over 30 days from the row id so that the daily and
recency analytics have something to group; ingestion time equals event time,
which keeps every derived value deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.functions.text import content_hash, image_hash, url_host

# The time spread of the test views (2024-01-01 UTC, 1000 slots
# of 2592 s = 30 days) and the recency anchor of the analytics.
EPOCH_2024_01_01 = 1704067200
SLOT_SECONDS = 2592
SLOTS = 1000
TEST_AS_OF = "2024-01-31"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def event_ts(id_col: Column) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH_2024_01_01) + (id_col % SLOTS) * SLOT_SECONDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rid = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    ts = event_ts(F.col("doc_id"))
    return d.select(
        rid.alias("id"),
        F.col("source"),
        F.substring("text", 1, 60).alias("title"),
        F.col("text"),
        F.lit(None).cast("string").alias("url"),
        F.date_format(ts, ISO_FORMAT).alias("timestamp"),
        F.lit(None).cast("string").alias("author"),
        F.create_map(F.lit("lang"), F.col("lang"),
                     F.lit("n_chars"), F.col("n_chars").cast("string")).alias("metadata"),
        ts.alias("ingestion_timestamp"),
        content_hash(rid, F.col("text"), F.col("source")).alias("content_hash"),
    )


def images_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    rid = F.concat(F.lit("page_"), F.col("page_id").cast("string"))
    ts = event_ts(F.col("page_id"))
    return p.select(
        rid.alias("id"),
        url_host(F.col("url")).alias("source"),
        F.col("url"),
        F.col("url").alias("filepath"),
        F.octet_length("html").cast("bigint").alias("file_size"),
        F.date_format(ts, ISO_FORMAT).alias("timestamp"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        F.lit(None).cast("string").alias("dimensions"),
        F.lit(None).cast("string").alias("category"),
        ts.alias("ingestion_timestamp"),
        image_hash(rid, F.col("url")).alias("image_hash"),
        F.col("html").alias("content"),
    )
