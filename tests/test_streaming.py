import datetime as dt

from pyspark.sql import functions as F

from contentrisk.functions.dictionary import analysis_dictionary
from contentrisk.operators.enrich import enrich_text
from contentrisk.operators.ingest import ingest_text
from contentrisk.session import scratch_path
from contentrisk.streaming.enrichment import (
    compact,
    read_latest,
    start_text_enrichment,
    upsert_batch_writer,
)

LANDING = ("id string, source string, title string, text string, url string, timestamp string, "
           "author string, metadata map<string,string>")


def raw_rows(spark, rows):
    df = spark.createDataFrame([(i, s, None, t, None, "2024-01-01T00:00:00", None, None) for i, s, t in rows],
                               LANDING)
    return ingest_text(df, as_of=dt.datetime(2024, 1, 1))


def run(spark, source, target, ckpt):
    q = start_text_enrichment(spark, source, target, analysis_dictionary(), checkpoint=ckpt,
                              trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None


def summary(df):
    return sorted((r.id, r.threat_severity, tuple(r.threat_categories)) for r in df.collect())


def test_stream_replay_restart_and_change(spark):
    source, target, ckpt = (scratch_path(spark, n) for n in ("src", "tgt", "ckpt"))
    first = raw_rows(spark, [("1", "s", "you idiot"), ("2", "s", "nice day"), ("3", "t", "the token")])
    first.write.mode("append").parquet(source)
    first.write.mode("append").parquet(source)              # replayed file
    run(spark, source, target, ckpt)
    latest = read_latest(spark, target, "content_hash")
    assert latest.count() == 3
    assert summary(latest) == summary(enrich_text(first, analysis_dictionary()))

    # restart from the checkpoint: only the new file is read; a new record and the
    # same id with changed text (a new key) are added
    second = raw_rows(spark, [("4", "s", "worthless trash"), ("1", "s", "you idiot and a worthless one")])
    second.write.mode("append").parquet(source)
    run(spark, source, target, ckpt)
    latest = read_latest(spark, target, "content_hash")
    assert latest.count() == 5
    sev = {(r.id, r.text): r.threat_severity for r in latest.collect()}
    assert sev[("1", "you idiot and a worthless one")] == "high" and sev[("1", "you idiot")] == "medium"
    batches = {r.batch_id for r in spark.read.parquet(target).select("batch_id").distinct().collect()}
    assert len(batches) >= 3          # one folder per non-empty micro-batch (one file each)

    snap_path = scratch_path(spark, "snap")
    snap = compact(spark, target, "content_hash", snap_path)
    assert summary(snap) == summary(latest)

    # newer batches after the snapshot: read = snapshot + only the newer folders
    third = raw_rows(spark, [("5", "t", "hate"), ("2", "s", "nice day")])    # '2' is a replayed key
    third.write.mode("append").parquet(source)
    run(spark, source, target, ckpt)
    full = read_latest(spark, target, "content_hash")
    incremental = read_latest(spark, target, "content_hash", snapshot=snap_path)
    assert full.count() == 6 and summary(incremental) == summary(full)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = incremental._jdf.queryExecution().executedPlan().toString()
    import re
    pruned = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("batch_id" in f for f in pruned)        # older batch folders are pruned, not read


def test_retried_batch_replaces_itself(spark):
    target = scratch_path(spark, "retry")
    rows = enrich_text(raw_rows(spark, [("1", "s", "hate"), ("1", "s", "hate"), ("2", "s", "ok")]),
                       analysis_dictionary(), enrichment_ts=F.lit(dt.datetime(2024, 1, 2)))
    writer = upsert_batch_writer(target, "tok", "content_hash")
    writer(rows, 0)
    writer(rows, 0)                                           # the same batch, retried
    assert spark.read.parquet(target).count() == 2            # one row per key, no duplicates


def test_crash_after_write_before_commit(spark):
    """The batch function writes, then the job dies before the offset commit; a restart
    re-runs that batch id, which overwrites its own folder: the result equals batch enrichment."""
    from contentrisk.streaming.enrichment import stream_token

    source, target, ckpt = (scratch_path(spark, n) for n in ("csrc", "ctgt", "cckpt"))
    rows = raw_rows(spark, [("1", "s", "you idiot"), ("2", "s", "plan the attack"), ("3", "s", "calm")])
    rows.coalesce(1).write.mode("append").parquet(source)
    d = analysis_dictionary()
    writer = upsert_batch_writer(target, stream_token(ckpt), "content_hash")

    def crash_after_write(batch, batch_id):
        writer(batch, batch_id)
        raise RuntimeError("simulated crash before commit")

    enriched = enrich_text(spark.readStream.schema(rows.schema).parquet(source), d).drop("combined_text")
    q = (enriched.writeStream.foreachBatch(crash_after_write).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None
    run(spark, source, target, ckpt)                       # restart: batch 0 runs again
    latest = read_latest(spark, target, "content_hash")
    assert summary(latest) == summary(enrich_text(rows, d))
    assert {r.batch_id for r in spark.read.parquet(target).select("batch_id").collect()} == {0}


def test_image_stream_joins_landed_bytes(spark):
    import os

    from contentrisk.operators.ingest import ingest_images
    from contentrisk.streaming.enrichment import start_image_enrichment

    files = scratch_path(spark, "img_files")
    local = files[len("file:"):] if files.startswith("file:") else files
    for name, body in (("p1.html", b"<html><p>worthless trash</p></html>"), ("p2.html", b"<p>fine</p>")):
        with open(os.path.join(local, name), "wb") as f:
            f.write(body)
    meta = spark.createDataFrame(
        [(f"img{i}", "s", None, f"{local}/p{i}.html", 10, "2024-01-01T00:00:00", None, None, None) for i in (1, 2)],
        "id string, source string, url string, filepath string, file_size bigint, timestamp string, "
        "metadata map<string,string>, dimensions string, category string")
    source, target = scratch_path(spark, "img_src"), scratch_path(spark, "img_tgt")
    ingest_images(meta, as_of="2024-01-01").write.mode("append").parquet(source)
    q = start_image_enrichment(spark, source, target, analysis_dictionary(), checkpoint=scratch_path(spark, "ick"),
                               trigger={"availableNow": True}, image_files=local)
    q.awaitTermination()
    assert q.exception() is None
    got = {r.id: (r.extracted_text, r.threat_severity) for r in read_latest(spark, target, "image_hash").collect()}
    assert got == {"img1": ("worthless trash", "high"), "img2": ("fine", "benign")}


def test_replays_within_the_horizon_write_nothing(spark):
    source, target, ckpt = (scratch_path(spark, n) for n in ("hsrc", "htgt", "hckpt"))

    def go():
        q = start_text_enrichment(spark, source, target, analysis_dictionary(), checkpoint=ckpt, trigger={"availableNow": True},
                                  max_files_per_trigger=1, horizon="1 day")
        q.awaitTermination()
        assert q.exception() is None
        return sorted(r.id for r in spark.read.parquet(target).collect())

    rows = raw_rows(spark, [("1", "s", "you idiot"), ("2", "s", "nice day")]).coalesce(1)
    rows.write.mode("append").parquet(source)
    rows.write.mode("append").parquet(source)                    # replayed
    assert go() == ["1", "2"]                                    # of all batch folders together
    rows.unionByName(raw_rows(spark, [("3", "s", "new")])).coalesce(1).write.mode("append").parquet(source)
    assert go() == ["1", "2", "3"]                               # the state outlives a restart


def test_a_landing_of_many_files_is_one_batch(spark):
    from contentrisk.plans.queries import _run_stream

    rows = raw_rows(spark, [(str(k), "s", "you idiot" if k % 3 else "fine") for k in range(30)]).repartition(7)
    for horizon, batches in ((None, {0, 1}), ("1 day", {0})):
        target = _run_stream(start_text_enrichment, spark, rows, "many", horizon=horizon)
        written = spark.read.parquet(target)
        assert {r.batch_id for r in written.select("batch_id").distinct().collect()} == batches      # a file a batch: 14
        assert written.count() == 30 * len(batches) and read_latest(spark, target, "content_hash").count() == 30


def test_image_landings_are_batches_whose_metrics_count_copies(spark):
    from contentrisk.operators.ingest import ingest_images
    from contentrisk.plans.queries import _run_stream
    from contentrisk.streaming.enrichment import start_image_enrichment

    meta = spark.createDataFrame(
        [(f"img{k}", "s", None, f"/p{k}.html", 10, "2024-01-01T00:00:00", None, None, None) for k in [*range(12), 3, 3, 5]],
        "id string, source string, url string, filepath string, file_size bigint, timestamp string, "
        "metadata map<string,string>, dimensions string, category string")
    content = F.when(F.col("id") == "img3", "<p>worthless trash</p>").otherwise("<p>fine</p>")
    raw = ingest_images(meta, as_of="2024-01-01").withColumn("content", content).repartition(5)
    metrics = scratch_path(spark, "metrics")
    target = _run_stream(start_image_enrichment, spark, raw, "images", metrics_path=metrics)
    assert sorted(tuple(r) for r in spark.read.parquet(metrics).collect()) == [(15, 3, 15, 0), (15, 3, 15, 1)]
    assert spark.read.parquet(target).count() == 2 * 12      # one row a key and batch


def test_the_write_behind_state_is_adaptive(spark):
    from contentrisk.streaming.enrichment import adaptive

    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "false")
        with adaptive(spark):
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)
