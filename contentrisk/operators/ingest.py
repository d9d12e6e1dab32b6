"""Ingest: landed records -> validated, hashed raw tables, loaded idempotently."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.functions.text import content_hash, image_hash
from contentrisk.operators.enrich import TsSpec, ts_column
from contentrisk.operators.key_filter import rows_of_new_keys
from contentrisk.operators.tables import dedupe_latest, read_table, rebalance_for_write
from contentrisk.schemas import IMAGE_RAW, TEXT_RAW


def ingest_text(landing: DataFrame, as_of: TsSpec = None) -> DataFrame:
    """Add ingestion time and content hash; keep records with id, text and source."""
    out = (landing
           .withColumn("ingestion_timestamp", ts_column(as_of))
           .withColumn("content_hash", content_hash(F.col("id"), F.col("text"), F.col("source")))
           .where(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("source").isNotNull()))
    return out.select(*TEXT_RAW.fieldNames())


def ingest_images(landing: DataFrame, as_of: TsSpec = None) -> DataFrame:
    """Add ingestion time and metadata hash; keep records with id, filepath and source."""
    out = (landing
           .withColumn("ingestion_timestamp", ts_column(as_of))
           .withColumn("image_hash", image_hash(F.col("id"), F.col("filepath")))
           .where(F.col("id").isNotNull() & F.col("filepath").isNotNull() & F.col("source").isNotNull()))
    return out.select(*IMAGE_RAW.fieldNames())


def load_raw(new: DataFrame, table_path: str, key: str, partition_by: str = "source") -> None:
    """Idempotent load: append only keys the table does not hold yet.

    The table folder stays append-only (a clean file-stream source); loading the
    same landing files again appends nothing. What the table holds is told by a
    filter beside it (``key_filter``), so a load doesn't read the table's keys.
    """
    spark = new.sparkSession
    try:
        existing = read_table(spark, table_path, new.schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = None   # no table yet
    rows = dedupe_latest(new if existing is None else rows_of_new_keys(existing, table_path, new, key), key)
    rebalance_for_write(rows, [partition_by]).write.mode("append").partitionBy(partition_by).parquet(table_path)
