"""Job-level entry points: the pipeline as a user runs it.

Each job is one plan and one write (statistics come from one aggregate over
what was written, not from repeated counts). Paths may be any Hadoop-supported
URI; nothing checks existence on the driver's local disk.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contentrisk.functions.dictionary import ThreatDictionary
from contentrisk.operators import stats
from contentrisk.operators.enrich import enrich_images, enrich_text
from contentrisk.operators.extract import attach_content
from contentrisk.operators.ingest import ingest_images, ingest_text, load_raw
from contentrisk.operators.tables import read_table, write_table
from contentrisk.plans.catalog import register_views, run_all, save_results
from contentrisk.sources.landing import (
    collect_dictionary,
    keyword_lookup,
    load_dictionary,
    scan_binary_files,
    scan_image_json,
    scan_text_json,
)
from contentrisk.schemas import IMAGE_RAW, TEXT_RAW
from contentrisk.streaming.compaction import append_batch
from contentrisk.streaming.enrichment import read_latest, start_image_enrichment, start_text_enrichment

@dataclass
class PipelineConfig:
    """The settings the reference keeps in its YAML file, as parameters."""
    text_landing: str
    image_landing: str
    dictionary_file: str
    tables: str                                   # base folder of all tables
    checkpoints: str                              # base folder of stream checkpoints
    trigger_seconds: int = 10
    multi_line_json: bool = True
    image_files: str | None = None                # landed image bytes (binaryFile), joined on filepath
    metrics: str | None = None                    # folder of the image stream's per-batch metrics
    table_names: dict = field(default_factory=lambda: {
        "text_raw": "text_raw", "images_raw": "images_raw", "threat_mappings": "threat_mappings",
        "threat_keywords_lookup": "threat_keywords_lookup",
        "text_enriched": "text_enriched", "images_enriched": "images_enriched"})

    def table(self, name: str) -> str:
        return f"{self.tables.rstrip('/')}/{self.table_names[name]}"


def run_text_ingestion(spark: SparkSession, cfg: PipelineConfig, as_of=None) -> DataFrame:
    landing = scan_text_json(spark, f"{cfg.text_landing.rstrip('/')}/*.json", cfg.multi_line_json)
    load_raw(ingest_text(landing, as_of), cfg.table("text_raw"), "content_hash")
    return stats.ingest_stats_text(read_table(spark, cfg.table("text_raw"), TEXT_RAW))


def run_image_ingestion(spark: SparkSession, cfg: PipelineConfig, as_of=None) -> DataFrame:
    landing = scan_image_json(spark, f"{cfg.image_landing.rstrip('/')}/*.json", cfg.multi_line_json)
    load_raw(ingest_images(landing, as_of), cfg.table("images_raw"), "image_hash")
    return stats.ingest_stats_images(read_table(spark, cfg.table("images_raw"), IMAGE_RAW))


def run_dictionary_ingestion(spark: SparkSession, cfg: PipelineConfig, as_of=None) -> ThreatDictionary:
    """Dictionary file -> dictionary table + keyword lookup table (both overwritten)."""
    d = write_table(load_dictionary(spark, cfg.dictionary_file, as_of), "dict",
                    path=cfg.table("threat_mappings"))
    write_table(keyword_lookup(d), "lookup", path=cfg.table("threat_keywords_lookup"))
    return collect_dictionary(d)


def run_batch_enrichment(spark: SparkSession, cfg: PipelineConfig, dictionary: ThreatDictionary,
                         engine: str = "arrow", extractor="html") -> tuple[DataFrame, DataFrame]:
    """Batch twin of the streams: enrich both raw tables into the enriched tables.

    Each run is a batch of its own in the layout that the streams use, so none overwrites
    another; what comes back is the latest row per key of all.
    """
    append_batch(enrich_text(read_table(spark, cfg.table("text_raw"), TEXT_RAW), dictionary, engine=engine).drop("combined_text"),
                 cfg.table("text_enriched"), "content_hash")
    images_raw = read_table(spark, cfg.table("images_raw"))
    if "content" not in images_raw.columns:
        if cfg.image_files:
            images_raw = attach_content(images_raw, scan_binary_files(spark, cfg.image_files))
        else:   # metadata only: no bytes to extract from
            images_raw = images_raw.withColumn("content", F.lit(None).cast("binary"))
    images = enrich_images(images_raw, dictionary, extractor=extractor, engine=engine)
    append_batch(images, cfg.table("images_enriched"), "image_hash")
    return enriched(spark, cfg)


def enriched(spark: SparkSession, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """The enriched tables as the analytics read them: what batch and streams wrote, latest per key."""
    return (read_latest(spark, cfg.table("text_enriched"), "content_hash"),
            read_latest(spark, cfg.table("images_enriched"), "image_hash"))


def start_streams(spark: SparkSession, cfg: PipelineConfig, dictionary: ThreatDictionary,
                  available_now: bool = False) -> list[StreamingQuery]:
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{cfg.trigger_seconds} seconds"}
    base = cfg.checkpoints.rstrip("/")
    return [
        start_text_enrichment(spark, cfg.table("text_raw"), cfg.table("text_enriched"), dictionary,
                              checkpoint=f"{base}/text_enrichment", trigger=trigger),
        start_image_enrichment(spark, cfg.table("images_raw"), cfg.table("images_enriched"), dictionary,
                               checkpoint=f"{base}/image_enrichment", trigger=trigger,
                               image_files=cfg.image_files, metrics_path=cfg.metrics),
    ]


def run_analytics(spark: SparkSession, text_enriched: DataFrame, images_enriched: DataFrame,
                  as_of: str | None = None, output_dir: str | None = None) -> dict[str, DataFrame]:
    register_views(spark, text_enriched, images_enriched)
    results = run_all(text_enriched, images_enriched, as_of)
    if output_dir:
        save_results(results, output_dir)
    return results
