"""Enrichment: the same functions serve batch jobs and streaming micro-batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentrisk.functions.dictionary import ThreatDictionary
from contentrisk.functions.matching import add_threat_columns
from contentrisk.operators.extract import Extractor, extract_text
from contentrisk.operators.partitioning import spread_for_cpu

TsSpec = Column | str | dt.datetime | None


def ts_column(spec: TsSpec) -> Column:
    """Enrichment time: now (default), a fixed instant, or a per-row column."""
    if spec is None:
        return F.current_timestamp()
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, dt.datetime):
        return F.lit(spec)
    return F.to_timestamp(F.lit(spec))


def _finish(df: DataFrame, hash_col: str, enrichment_ts: TsSpec) -> DataFrame:
    ts = ts_column(enrichment_ts)
    out = df.withColumns({
        "is_threat": F.size("detected_threats") > 0,
        "enrichment_timestamp": ts,
        "threat_categories": F.col("detected_threats.category"),
    })
    return out.withColumn("enrichment_id", F.md5(F.concat_ws(
        "||", F.col("id"), F.col(hash_col), F.col("enrichment_timestamp").cast("string"))))


def enrich_text(df: DataFrame, dictionary: ThreatDictionary,
                enrichment_ts: TsSpec = None, engine: str = "arrow",
                partitions: int | None = None) -> DataFrame:
    """text_raw -> text_enriched: combined title+text, threats, severity, flags.

    ``partitions``: spread the rows first, for an input of fewer splits than cores.
    """
    out = spread_for_cpu(df, partitions).withColumn("combined_text", F.concat_ws(" ", F.col("title"), F.col("text")))
    out = add_threat_columns(out, F.col("combined_text"), dictionary, engine=engine)
    return _finish(out, "content_hash", enrichment_ts)


def enrich_images(df: DataFrame, dictionary: ThreatDictionary,
                  extractor: str | Extractor = "html", content_col: str = "content",
                  enrichment_ts: TsSpec = None, keep_content: bool = False,
                  engine: str = "arrow", partitions: int | None = None) -> DataFrame:
    """images_raw (+ content) -> images_enriched: extracted text, threats, flags, length."""
    out = extract_text(spread_for_cpu(df, partitions), content_col, extractor, "extracted_text")
    out = out.withColumn("ocr_success", F.coalesce(F.col("extracted_text") != "", F.lit(False)))
    out = add_threat_columns(out, F.col("extracted_text"), dictionary, engine=engine)
    out = _finish(out, "image_hash", enrichment_ts)
    out = out.withColumn("text_length", F.coalesce(F.length("extracted_text"), F.lit(0)))
    return out if keep_content else out.drop(content_col)
