"""Maintained statistics equal a recomputation over the upserted table after every batch."""

import datetime as dt
import random

from contentrisk.operators import stats
from contentrisk.session import scratch_path
from contentrisk.streaming import compaction as C
from contentrisk.streaming import maintained as M

SCHEMA = ("id string, image_hash string, source string, threat_severity string, enrichment_timestamp timestamp, is_threat boolean, "
          "threat_categories array<string>, ocr_success boolean, text_length int")


def batch(spark, rng, n):
    rows = []
    for _ in range(n):
        k, threat, ocr = rng.randint(0, 30), rng.random() < 0.5, rng.random() < 0.6
        rows.append((f"i{k}", f"h{k}", rng.choice("st"), rng.choice(["low", "high"]) if threat else "benign",
                     dt.datetime(2024, 1, rng.randint(1, 4), rng.randint(0, 23)), threat, rng.sample(["a", "b", "c"], rng.randint(1, 3)) if threat else [],
                     ocr, rng.randint(1, 90) if ocr else 0))
    return spark.createDataFrame(rows, SCHEMA)


def same(spark, target, statistics):
    table, kept = C.read_latest(spark, target, "image_hash"), M.maintained(spark, statistics)
    want, got = stats.stream_stats_images(table).first(), M.totals(kept).first()
    assert tuple(want)[:4] == tuple(got)[:4] and abs((want.avg_text_length or 0) - (got.avg_text_length or 0)) < 1e-9
    assert {tuple(r) for r in stats.severity_counts(table).collect()} == {tuple(r) for r in M.severity_counts(kept).filter("count > 0").collect()}
    assert {tuple(r) for r in stats.category_distribution(table).collect()} == {tuple(r) for r in M.category_distribution(kept).filter("count > 0").collect()}
    days = table.selectExpr("to_date(enrichment_timestamp) AS d", "source", "is_threat").groupBy("d", "source").agg({"*": "count"}).collect()
    assert {tuple(r) for r in days} == {(r.event_date, r.source, r.total_count) for r in M.daily_counts(kept).filter("total_count > 0").collect()}


def test_equals_recomputation_after_upserts(spark):
    rng = random.Random(1)
    target, statistics, snap = (scratch_path(spark, n) for n in ("table", "stats", "snap"))
    for k in range(2):
        C.write_batch(batch(spark, rng, 25), target, "tok", k, "image_hash")
        M.write_deltas(spark, target, statistics, "tok", k, "image_hash")
    same(spark, target, statistics)
    C.write_batch(batch(spark, rng, 25), target, "tok", 1, "image_hash")      # the last batch, tried again
    M.write_deltas(spark, target, statistics, "tok", 1, "image_hash")
    same(spark, target, statistics)
    C.compact(spark, target, "image_hash", snap, 4)
    C.write_batch(batch(spark, rng, 20), target, "tok", 2, "image_hash")
    M.write_deltas(spark, target, statistics, "tok", 2, "image_hash", snap)
    same(spark, target, statistics)
