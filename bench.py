"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Timings are best-of-$BENCH_RUNS (default 3) wall-clock seconds per query,
each fully executed into a no-op sink, after one warm-up pass of every query
over $BENCH_WARMUP_DIR (default sf0.01; the same plans, so code generation and
the JIT are warm; set it empty to skip). Enrichment (the dictionary matching
and HTML extraction) is timed as the job that writes the enriched tables;
the analytics then run over those written tables, as in the pipeline.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contentrisk.operators.tables import write_table  # noqa: E402
from contentrisk.plans import analytics  # noqa: E402
from contentrisk.plans import queries as Q  # noqa: E402
from contentrisk.session import get_session  # noqa: E402
from contentrisk.sources import testdata  # noqa: E402
from contentrisk.streaming.enrichment import read_latest, start_text_enrichment  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARMUP_DIR = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")

OPERATOR_QUERIES = ["detect_threats", "detect_threats_arrow", "detect_threats_join",
                    "keyword_lookup_join", "merge_upsert", "merge_insert_only", "fallback_classifier_a", "normalize_wiki", "normalize_rss",
                    "image_catalog", "extract_text"]


def best_of(fn, runs: int = RUNS) -> float:
    best = float("inf")
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run_all(spark, sf_dir: str, runs: int) -> dict[str, float]:
    timings: dict[str, float] = {}
    holder = {}

    def enrich_text_job():
        holder["text"] = write_table(Q.text_enriched(spark, sf_dir).drop("combined_text"), "bench_text")

    def enrich_images_job():
        holder["images"] = write_table(Q.images_enriched(spark, sf_dir), "bench_images")

    timings["enrich_text"] = best_of(enrich_text_job, runs)
    timings["enrich_text_native"] = best_of(lambda: write_table(
        Q.text_enriched(spark, sf_dir, engine="native").drop("combined_text"), "bench_text_native"), runs)
    timings["enrich_images"] = best_of(enrich_images_job, runs)
    text, images = holder["text"], holder["images"]
    for name, fn in analytics.ANALYTICS.items():
        timings[name] = best_of(lambda fn=fn: noop(fn(text, images)), runs)
    target = Q._run_stream(start_text_enrichment, spark, testdata.text_raw(spark, sf_dir), "bench_stream")   # not timed
    timings["read_latest"] = best_of(lambda: noop(read_latest(spark, target, "content_hash")), runs)
    for name in OPERATOR_QUERIES:
        timings[name] = best_of(lambda name=name: noop(Q.QUERIES[name](spark, sf_dir)), runs)
    return timings


def main() -> None:
    spark = get_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS))
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    if WARMUP_DIR and os.path.isdir(WARMUP_DIR):
        run_all(spark, WARMUP_DIR, runs=1)
    timings = run_all(spark, SF_DIR, runs=RUNS)

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": timings, "sf": float(sf.group(1)) if sf else SF_DIR,
                      "cpus": int(CPUS), "runs": RUNS}))
    spark.stop()


if __name__ == "__main__":
    main()
