"""End to end: landed JSON + dictionary file -> raw tables -> enriched tables -> analytics."""

import json

from pyspark.sql import functions as F

from contentrisk.functions.dictionary import REFERENCE_DICTIONARY
from contentrisk.jobs import (
    PipelineConfig,
    run_analytics,
    run_batch_enrichment,
    run_dictionary_ingestion,
    run_image_ingestion,
    run_text_ingestion,
)
from contentrisk.plans import queries as Q
from contentrisk.session import scratch_path
from tests.conftest import SF_SMALL


def test_pipeline_end_to_end(spark):
    base = scratch_path(spark, "pipeline")
    cfg = PipelineConfig(text_landing=f"{base}/landing/text", image_landing=f"{base}/landing/images",
                         dictionary_file=f"{base}/threat_mappings.json", tables=f"{base}/tables",
                         checkpoints=f"{base}/ckpt", multi_line_json=False)
    import os
    os.makedirs(base, exist_ok=True)
    with open(cfg.dictionary_file, "w") as f:
        json.dump(REFERENCE_DICTIONARY, f)
    # landing derived from the test tables (JSON lines)
    text = Q.text_landing(spark, SF_SMALL)
    text.write.mode("overwrite").json(cfg.text_landing)                  # part-*.json files
    images = Q.image_landing(spark, SF_SMALL)
    images.write.mode("overwrite").json(cfg.image_landing)

    d = run_dictionary_ingestion(spark, cfg, as_of="2024-01-31")
    assert len(d.categories) == 6
    s1 = run_text_ingestion(spark, cfg, as_of="2024-01-31").first()
    s2 = run_text_ingestion(spark, cfg, as_of="2024-01-31").first()       # rerun: idempotent
    assert s1.total_records == s2.total_records == text.count()
    assert run_image_ingestion(spark, cfg, as_of="2024-01-31").first().total_images == images.count()

    te, ie = run_batch_enrichment(spark, cfg, d)
    assert te.count() == text.count() and ie.count() == images.count()
    assert te.where(F.col("is_threat")).count() > 0                        # 'ied', 'gun' fire on the corpus
    results = run_analytics(spark, te, ie, as_of="2024-01-31", output_dir=f"{base}/results")
    assert results["daily_threat_ratio"].count() > 0
    assert spark.sql("SELECT COUNT(*) n FROM text_enriched").first().n == te.count()


def test_streams_over_ingested_tables(spark):
    import os

    from contentrisk.jobs import start_streams
    from contentrisk.operators.enrich import enrich_text
    from contentrisk.streaming.enrichment import read_latest

    base = scratch_path(spark, "pipeline_stream")
    names = {"text_raw": "text_raw", "images_raw": "images_raw", "threat_mappings": "tm",
             "threat_keywords_lookup": "tkl", "text_enriched": "text_enriched_s",
             "images_enriched": "images_enriched_s"}
    cfg = PipelineConfig(text_landing=f"{base}/landing/text", image_landing=f"{base}/landing/images",
                         dictionary_file=f"{base}/d.json", tables=f"{base}/tables",
                         checkpoints=f"{base}/ckpt", multi_line_json=False, table_names=names)
    os.makedirs(base, exist_ok=True)
    with open(cfg.dictionary_file, "w") as f:
        json.dump(REFERENCE_DICTIONARY, f)
    Q.text_landing(spark, SF_SMALL).write.mode("overwrite").json(cfg.text_landing)
    Q.image_landing(spark, SF_SMALL).write.mode("overwrite").json(cfg.image_landing)
    d = run_dictionary_ingestion(spark, cfg)
    run_text_ingestion(spark, cfg, as_of="2024-01-31")
    run_image_ingestion(spark, cfg, as_of="2024-01-31")
    for q in start_streams(spark, cfg, d, available_now=True):
        q.awaitTermination()
        assert q.exception() is None
    text = read_latest(spark, cfg.table("text_enriched"), "content_hash")
    batch = enrich_text(spark.read.parquet(cfg.table("text_raw")), d)
    assert sorted((r.id, r.threat_severity, tuple(r.threat_categories)) for r in text.collect()) == \
        sorted((r.id, r.threat_severity, tuple(r.threat_categories)) for r in batch.collect())
    images = read_latest(spark, cfg.table("images_enriched"), "image_hash")
    assert images.count() == Q.image_landing(spark, SF_SMALL).count()
    assert images.where("ocr_success").count() == 0          # metadata only, no landed bytes
