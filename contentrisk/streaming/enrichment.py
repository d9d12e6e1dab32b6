"""Structured Streaming enrichment with replay-safe upserts on plain Parquet.

Source: the append-only raw table folder (file source, declared schema).
Transform: the same ``enrich_text`` / ``enrich_images`` used in batch.
Sink: ``foreachBatch`` writes each micro-batch, reduced to one row per key,
into its own folder ``<target>/stream=<token>/batch_id=<n>/attempt=<id>/`` partitioned by
(threat_severity, source), overwriting only that batch's folder. A batch retried
after a failure therefore replaces itself, and a replayed input file only
adds rows that latest-wins reading collapses by key. ``read_latest`` and
``compact`` (in ``compaction``) give the upserted table and fold it into a snapshot.

``token`` comes from the checkpoint path: batch ids restart at 0 with a new
checkpoint, so each checkpoint writes under its own token. The batch job writes under
the token ``batch``, each run as a batch of its own (``compaction.append_batch``).
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contentrisk.functions.dictionary import ThreatDictionary
from contentrisk.operators.enrich import enrich_images, enrich_text
from contentrisk.operators.extract import attach_content, same_path
from contentrisk.operators.stats import batch_counts
from contentrisk.operators.tables import free_name
from contentrisk.schemas import IMAGE_RAW, TEXT_RAW
from contentrisk.session import scratch_path
from contentrisk.sources.landing import scan_binary_files
from contentrisk.streaming.compaction import compact, read_latest, write_batch  # noqa: F401
from contentrisk.streaming.maintained import write_deltas

def stream_token(checkpoint: str) -> str:
    return hashlib.md5(checkpoint.encode("utf-8")).hexdigest()[:12]


def upsert_batch_writer(target: str, token: str, key: str, metrics_path: str | None = None, prepare=None,
                        statistics: str | None = None, snapshot: str | None = None, stateful: bool = False):
    """foreachBatch function: ``prepare`` (if any), dedupe by key, write this batch's own folder, log its metrics
    and count it into the maintained ``statistics``. The metrics are observed while the rows are written, so a batch is
    enriched once: what ``prepare`` makes beside the key is not made for the count of the keys. A batch of a ``stateful``
    stream is read once, too, and comes dealt by its key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, []

        def watch(part: DataFrame) -> DataFrame:
            seen.append(Observation())
            return part.observe(seen[-1], *batch_counts(part))

        with adaptive(spark) if stateful else nullcontext():
            batch = prepare(batch) if prepare else batch
            if not write_batch(batch, target, token, batch_id, key, watch, count_first=prepare is not None and not stateful):
                return   # an empty batch
        if metrics_path:
            # the folder name carries batch_id (read back as a partition column)
            got = [part.get for part in seen]
            row = spark.createDataFrame([tuple(sum(part[c] for part in got) for c in got[0])], ", ".join(f"{c} long" for c in got[0]))
            row.coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch_id}")
        if statistics:
            write_deltas(spark, target, statistics, token, batch_id, key, snapshot)

    return write


@contextmanager
def adaptive(spark: SparkSession):
    """Spark runs streams with state without adaptive execution. The write of a batch comes after the state, and needs
    it: without, a hot source of the rebalanced rows is written by one task."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)   # the stream's next batch is planned in this session


def _start(stream: DataFrame, target: str, checkpoint: str, key: str,
           trigger: dict, metrics_path: str | None, name: str, prepare, stateful: bool) -> StreamingQuery:
    writer = upsert_batch_writer(target, stream_token(checkpoint), key, metrics_path, prepare, stateful=stateful)
    return (stream.writeStream
            .queryName(name)
            .foreachBatch(writer)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start())


def first_seen(stream: DataFrame, key: str, horizon: str | None) -> DataFrame:
    """The rows whose key the stream hasn't had within ``horizon`` (as '2 days'; None: all rows).

    Keys are kept in the stream's state, checkpointed with it, until the horizon has passed since they were seen.
    The clock is the batch's own time, so no row is ever late: none is dropped but for its key. State is a key and
    a time each; a cluster with many keys chooses its state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    if horizon is None:
        return stream
    seen = free_name(stream, "seen_at")
    return stream.withColumn(seen, F.current_timestamp()).withWatermark(seen, horizon).dropDuplicatesWithinWatermark([key]).drop(seen)


def start_text_enrichment(spark: SparkSession, source: str, target: str, dictionary: ThreatDictionary,
                          checkpoint: str | None = None, trigger: dict | None = None,
                          max_files_per_trigger: int | None = None, horizon: str | None = None) -> StreamingQuery:
    """Text stream. With ``horizon`` a record landed again within it writes nothing (``first_seen``)."""
    reader = spark.readStream.schema(TEXT_RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = first_seen(reader.parquet(source), "content_hash", horizon)

    def prepare(batch: DataFrame) -> DataFrame:
        return enrich_text(batch, dictionary).drop("combined_text")

    return _start(stream, target, checkpoint or scratch_path(spark, "ckpt_text"), "content_hash",
                  trigger or {"processingTime": "10 seconds"}, None, "text_enrichment", prepare, horizon is not None)


def batch_files(batch: DataFrame, image_files: str) -> DataFrame:
    """The landed files that a batch's rows name: the listing alone (no bytes) is joined to the
    batch, so the paths that come back are no more than its rows; only those files are read."""
    spark = batch.sparkSession
    listing = scan_binary_files(spark, image_files)
    named = listing.select("path", same_path(F.col("path")).alias("p")).join(
        batch.select(same_path(F.col("filepath")).alias("p")), "p", "left_semi")
    paths = [r["path"] for r in named.select("path").collect()]
    return spark.read.format("binaryFile").load(paths) if paths else listing.filter("false")


def start_image_enrichment(spark: SparkSession, source: str, target: str, dictionary: ThreatDictionary,
                           checkpoint: str | None = None, trigger: dict | None = None,
                           extractor="html", content_col: str = "content",
                           metrics_path: str | None = None,
                           max_files_per_trigger: int | None = None,
                           image_files: str | None = None, horizon: str | None = None) -> StreamingQuery:
    """Image stream. Content comes from the raw table's ``content`` column or, when
    ``image_files`` is given, from the landed files that the batch's rows name, read when
    the batch runs (a static side of the join would fix its listing when the stream starts)."""
    if image_files:
        schema = IMAGE_RAW
    else:
        schema = T.StructType(IMAGE_RAW.fields + [T.StructField(content_col, T.StringType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = first_seen(reader.parquet(source), "image_hash", horizon)

    def prepare(batch: DataFrame) -> DataFrame:
        if image_files:
            batch = attach_content(batch, batch_files(batch, image_files), content_col=content_col)
        return enrich_images(batch, dictionary, extractor=extractor, content_col=content_col)

    return _start(stream, target, checkpoint or scratch_path(spark, "ckpt_images"), "image_hash",
                  trigger or {"processingTime": "10 seconds"}, metrics_path, "image_enrichment", prepare, horizon is not None)
