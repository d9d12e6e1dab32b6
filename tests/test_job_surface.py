"""Jobs over written tables: partition values, shared layout, image bytes, recency, scratch folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contentrisk import session
from contentrisk.functions.dictionary import analysis_dictionary
from contentrisk.jobs import PipelineConfig, enriched, run_batch_enrichment, start_streams
from contentrisk.operators.enrich import enrich_text
from contentrisk.operators.extract import extract_text
from contentrisk.operators.ingest import ingest_images, ingest_text, load_raw
from contentrisk.operators.tables import read_table
from contentrisk.plans import analytics
from contentrisk.schemas import IMAGE_LANDING, TEXT_LANDING, TEXT_RAW
from contentrisk.sources.normalize import valid_content
from contentrisk.streaming.enrichment import compact, read_latest


def landed(spark, ids, source=None):
    rows = [(str(i), source or ["001", "1", "2024-01-01"][i % 3], f"t{i}", "a bomb attack" if i % 2 else "calm", None, None, None, None) for i in ids]
    return ingest_text(spark.createDataFrame(rows, TEXT_LANDING), dt.datetime(2024, 1, 1))


def test_batch_and_streams_share_a_layout_and_keep_sources_as_text(spark, tmp_path):
    images = tmp_path / "img"
    images.mkdir()
    cfg = PipelineConfig("", "", "", f"file://{tmp_path}/tables", f"file://{tmp_path}/ckpt", image_files=f"file://{images}", metrics=f"file://{tmp_path}/metrics")
    meta = lambda i: ingest_images(spark.createDataFrame([(f"i{i}", "007", None, str(images / f"{i}.html"), 1, None, None, None, None)], IMAGE_LANDING), dt.datetime(2024, 1, 1))
    d = analysis_dictionary()

    def streams():
        for q in start_streams(spark, cfg, d, available_now=True):
            q.awaitTermination()

    load_raw(landed(spark, range(6)), cfg.table("text_raw"), "content_hash")
    (images / "0.html").write_text("<html><p>first bomb</p></html>")
    load_raw(meta(0), cfg.table("images_raw"), "image_hash")
    streams()
    run_batch_enrichment(spark, cfg, d)
    load_raw(landed(spark, range(12)), cfg.table("text_raw"), "content_hash")
    (images / "1.html").write_text("<html><p>late bomb</p></html>")      # landed after the first stream batch
    load_raw(meta(1), cfg.table("images_raw"), "image_hash")
    streams()
    run_batch_enrichment(spark, cfg, d)
    text, image = enriched(spark, cfg)
    raw = read_table(spark, cfg.table("text_raw"), TEXT_RAW)
    assert {r.source for r in raw.select("source").collect()} == {"001", "1", "2024-01-01"}
    cols = ["id", "source", "content_hash", "threat_severity", "is_threat"]
    want = sorted(map(tuple, enrich_text(raw, d).select(cols).collect()))
    assert sorted(map(tuple, text.select(cols).collect())) == want
    assert sorted((r.id, r.source, r.extracted_text) for r in image.collect()) == [("i0", "007", "first bomb"), ("i1", "007", "late bomb")]
    assert spark.read.parquet(cfg.metrics).count() == 2
    compact(spark, cfg.table("text_enriched"), "content_hash", f"file://{tmp_path}/snap")
    again = read_latest(spark, cfg.table("text_enriched"), "content_hash", f"file://{tmp_path}/snap")
    assert sorted(map(tuple, again.select(cols).collect())) == want


def test_unreadable_bytes_give_no_text_and_are_dropped(spark):
    rows = [(1, b"\x80\xfe\xff"), (2, "<!-- é -->\n<html><p>x</p></html>".encode()), (3, (" " * 63 + "é<html>").encode()), (4, b"\xff\xd8\xff\xe0junk"),
            (5, b"<?xml version='1.0'?>" + b" " * 100 + b"<!DOCTYPE html><html>y</html>"), (6, None), (7, b"plain")]
    df = spark.createDataFrame(rows, "id int, content binary")
    got = {r.id: r.extracted_text for r in extract_text(df).collect()}
    assert got[1] == got[4] == got[6] == "" and got[2] == "x" and len(got) == 7
    kept = {r.id: r.content_kind for r in valid_content(df, kinds=("jpeg", "html")).collect()}
    assert kept == {2: "html", 4: "jpeg", 5: "html"}


def test_a_damaged_table_is_not_taken_for_none(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        load_raw(landed(spark, [1]), f"file://{tmp_path}/raw", "content_hash")


def test_recency_is_today_unless_given(spark):
    rows = [("new", F.current_timestamp()), ("old", F.current_timestamp() - F.expr("INTERVAL 30 DAYS"))]
    base = None
    for i, ts in rows:
        one = spark.range(1).select(F.lit(i).alias("id"), F.lit("s").alias("source"), F.lit("t").alias("title"), F.lit("x").alias("text"), F.lit("low").alias("threat_severity"),
                                    F.lit(True).alias("is_threat"), F.array(F.lit(i)).alias("threat_categories"), ts.alias("enrichment_timestamp"),
                                    F.lit("").alias("extracted_text"), F.lit("p").alias("filepath"))
        base = one if base is None else base.unionByName(one)
    assert {r.id for r in analytics.latest_threats(base, base).collect()} == {"new"}
    assert {r.id for r in analytics.latest_threats_brief(base, base, "2024-01-31").collect()} == {"new", "old"}


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "yarn"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
