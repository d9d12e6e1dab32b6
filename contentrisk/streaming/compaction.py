"""The upserted table behind the streams and the batch job: batch folders, and a snapshot of them.

A table is a set of batch folders ``stream=<token>/batch_id=<n>/attempt=<id>``: a retried batch
overwrites its folder under a new attempt, a new run of the batch job is a new batch. The table's rows are the
latest of each key over all folders.

``compact`` folds folders into a snapshot whose rows are dealt over buckets by a hash of the key. It
notes every folder it has folded, attempt included, so a batch that is retried afterwards counts as new. The
next run starts from the last snapshot: it reads the new folders and, of the snapshot, the buckets that their
keys fall in, and writes those anew as one more generation; the other buckets stay where they are::

    <snapshot>/rows/gen=<g>/bucket=<b>/      the rows of the buckets that generation g wrote
    <snapshot>/folded/gen=<g>/               (stream, batch_id, attempt) of all folders in it
    <snapshot>/manifest/gen=<g>/             (bucket, at_gen): where each bucket's rows are; written last

A generation counts once its manifest is there: a run that died before writes the same generation again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.operators.tables import dedupe_latest, free_name, read_table, rebalance_for_write, row_hash, write_table

# Latest-wins order: newest enrichment, then the later batch, then id.
ORDER_LATEST = [("enrichment_timestamp", False), ("batch_id", False), ("id", True)]
# The same within a batch.
ORDER_IN_BATCH = [("enrichment_timestamp", False), ("id", True)]
FOLDER = ["stream", "batch_id", "attempt"]
PARTITIONS = ["threat_severity", "source"]
#: Buckets of a new snapshot; an old one keeps its own number.
BUCKETS = 64
#: Keys that come again in a batch are broadcast up to this many; beyond, all of its rows are compared.
BROADCAST_KEYS = 100_000
#: The token of the batch job's folders.
BATCH_JOB = "batch"

Folder = tuple[str, int, str]


def one_per_key(rows: DataFrame, key: str, watch: Callable[[DataFrame], DataFrame] = lambda part: part, count_first: bool = True) -> DataFrame:
    """``rows`` reduced to one row per key.

    The keys are counted first, which makes no other column, and only rows of keys that come again are compared;
    the others are not shuffled for it. ``count_first=False`` for rows that should be made once, or
    that are dealt by their key already. ``watch`` is put on the rows (in parts) before any is dropped.
    """
    if count_first:
        again = free_name(rows, "again")
        keys = rows.groupBy(F.col(key).alias(again)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(again)
        keys = write_table(keys, "keys-again")
        found = keys.count()
        if not found:
            return watch(rows)
        if found <= BROADCAST_KEYS:
            once, several = (rows.join(F.broadcast(keys), F.col(key).eqNullSafe(F.col(again)), how) for how in ("left_anti", "left_semi"))
            return watch(once).unionByName(dedupe_latest(watch(several), key, ORDER_IN_BATCH))
    return dedupe_latest(watch(rows), key, ORDER_IN_BATCH)


def write_batch(rows: DataFrame, target: str, token: str, batch_id: int, key: str,
                watch: Callable[[DataFrame], DataFrame] = lambda part: part, count_first: bool = True) -> bool:
    """Write one batch, reduced to one row per key (``one_per_key``), in place of any earlier attempt at it. Were there
    any rows?"""
    path = f"{target}/stream={token}/batch_id={batch_id}"
    reduced = one_per_key(rows, key, watch, count_first)
    (rebalance_for_write(reduced, PARTITIONS).withColumn("attempt", F.lit(uuid.uuid4().hex)).write.mode("overwrite")
     .partitionBy("attempt", *PARTITIONS).parquet(path))
    return bool(rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles())   # a listing, no job


def append_batch(rows: DataFrame, target: str, key: str) -> None:
    """Write a run of the batch job as a batch of its own, after all earlier ones."""
    earlier = [n for token, n, _ in folders(rows.sparkSession, target) if token == BATCH_JOB]
    write_batch(rows, target, BATCH_JOB, max(earlier, default=-1) + 1, key)


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None   # nothing written yet
        raise


def folders(spark: SparkSession, target: str) -> set[Folder]:
    """The batch folders of a table, from the file listing that any scan of it makes."""
    table = _table(spark, target)
    found = (re.search(r"/stream=([^/]+)/batch_id=(\d+)/attempt=([^/]+)/", f) for f in (table.inputFiles() if table is not None else ()))
    return {(m[1], int(m[2]), m[3]) for m in found if m}


def in_folders(chosen: set[Folder]) -> Column:
    """A filter on the partition columns, so that other folders are not read."""
    cond = F.lit(False)
    for token in sorted({f[0] for f in chosen}):
        own = [f for f in chosen if f[0] == token]
        cond = cond | ((F.col("stream") == token) & F.col("batch_id").isin([f[1] for f in own]) & F.col("attempt").isin([f[2] for f in own]))
    return cond


def last_generation(spark: SparkSession, snapshot: str) -> tuple[int, dict[int, int]]:
    """The snapshot's last generation (-1: none) and where each bucket's rows are (BUCKETS rows)."""
    manifest = _table(spark, f"{snapshot}/manifest")
    if manifest is None:
        return -1, {}
    gen = manifest.agg(F.max("gen")).first()[0]
    return gen, {r["bucket"]: r["at_gen"] for r in manifest.filter(F.col("gen") == gen).collect()}


def snapshot_rows(spark: SparkSession, snapshot: str, at: dict[int, int], only: set[int] | None = None) -> DataFrame | None:
    """The rows of the snapshot's buckets (of ``only`` these), by a filter on the partition columns."""
    at = {b: g for b, g in at.items() if g >= 0 and (only is None or b in only)}
    rows = _table(spark, f"{snapshot}/rows") if at else None
    if rows is None:
        return None
    cond = F.lit(False)
    for gen in sorted(set(at.values())):
        cond = cond | ((F.col("gen") == gen) & F.col("bucket").isin([b for b, g in at.items() if g == gen]))
    return rows.filter(cond).drop("gen", "bucket")


def folded(spark: SparkSession, snapshot: str, gen: int) -> set[Folder]:
    """The folders of the table that the snapshot holds: one narrow row a batch."""
    if gen < 0:
        return set()
    rows = read_table(spark, f"{snapshot}/folded").filter(F.col("gen") == gen)
    return {(r["stream"], r["batch_id"], r["attempt"]) for r in rows.collect()}


def compact(spark: SparkSession, target: str, key: str, snapshot: str, buckets: int = BUCKETS) -> DataFrame:
    """Fold the table's new batch folders into the snapshot, and give its rows. The folders stay as they are."""
    gen, at = last_generation(spark, snapshot)
    present = folders(spark, target)
    new = present - folded(spark, snapshot, gen)
    at = at or {b: -1 for b in range(buckets)}
    if new:
        bucket = F.pmod(F.xxhash64(key), F.lit(len(at))).cast("int")
        rows = read_table(spark, target).filter(in_folders(new))
        touched = {r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()}   # one row a bucket
        before = snapshot_rows(spark, snapshot, at, touched)
        both = rows if before is None else rows.unionByName(before, allowMissingColumns=True)
        # dealt by parts of the buckets, a few for each task: one shuffle brings a key's rows together and a bucket's
        # rows to few files
        part = free_name(both, "part")
        parts = len(at) * max(1, -(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // len(at)))
        dealt = both.withColumn(part, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")).repartition(part)
        latest = dedupe_latest(dealt, key, ORDER_LATEST, within=part).withColumn("bucket", bucket)
        gen += 1
        latest.write.mode("overwrite").partitionBy("bucket").parquet(f"{snapshot}/rows/gen={gen}")
        at = {b: gen if b in touched else g for b, g in at.items()}
        spark.createDataFrame(sorted(present), "stream string, batch_id int, attempt string").coalesce(1).write.mode("overwrite").parquet(f"{snapshot}/folded/gen={gen}")
        spark.createDataFrame(sorted(at.items()), "bucket int, at_gen int").coalesce(1).write.mode("overwrite").parquet(f"{snapshot}/manifest/gen={gen}")
    out = snapshot_rows(spark, snapshot, at)
    return read_table(spark, target).limit(0).drop(*FOLDER) if out is None else out.drop(*FOLDER)


def read_latest(spark: SparkSession, target: str, key: str, snapshot: str | None = None) -> DataFrame:
    """The upserted table: the latest row per key over every batch folder.

    With ``snapshot`` (written by ``compact``), only folders that it has not folded are read. Keys that
    they don't name keep the snapshot's row: these rows are neither sorted nor, where the new keys are few
    enough for a broadcast, shuffled.
    """
    table = read_table(spark, target)
    if snapshot is None:
        return dedupe_latest(table, key, ORDER_LATEST).drop(*FOLDER)
    gen, at = last_generation(spark, snapshot)
    snap = snapshot_rows(spark, snapshot, at)
    recent = table.filter(in_folders(folders(spark, target) - folded(spark, snapshot, gen)))
    if snap is None:
        return dedupe_latest(recent, key, ORDER_LATEST).drop(*FOLDER)
    keys = recent.select(F.col(key).alias("__new_key")).distinct()
    same = F.col(key).eqNullSafe(F.col("__new_key"))
    # hashed before the join, and joined by an inner one, below which Spark doesn't push the hash's columns: a reader
    # of a few columns shuffles these alone
    both = recent.withColumn("__old", F.lit(False)).unionByName(snap.withColumn("__old", F.lit(True)), allowMissingColumns=True)
    hashed = both.withColumn("__tie", row_hash(both.drop("__old")))
    held = hashed.filter("__old").join(keys, same).drop("__new_key")
    latest = dedupe_latest(hashed.filter("NOT __old").unionByName(held).drop("__old"), key, ORDER_LATEST, tie="__tie")
    return snap.join(keys, same, "left_anti").unionByName(latest, allowMissingColumns=True).drop(*FOLDER)
