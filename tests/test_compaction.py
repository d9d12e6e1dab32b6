"""The snapshot of an upserted table: incremental, by buckets, and right whatever is run again."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from contentrisk.operators.tables import dedupe_latest
from contentrisk.session import scratch_path
from contentrisk.streaming import compaction as C

SCHEMA = "id string, content_hash string, source string, threat_severity string, enrichment_timestamp timestamp"


def rows(spark, keys, severity, day):
    return spark.createDataFrame([(k, f"h{k}", "s", severity, dt.datetime(2024, 1, day)) for k in keys], SCHEMA)


def state(df):
    got = df.collect()
    assert len({r.id for r in got}) == len(got)
    return {r.id: r.threat_severity for r in got}


@pytest.fixture
def paths(spark):
    return scratch_path(spark, "table"), scratch_path(spark, "snap")


def test_runs_after_a_compaction_are_seen(spark, paths):
    target, snap = paths
    C.append_batch(rows(spark, "abc", "low", 1), target, "content_hash")
    assert state(C.compact(spark, target, "content_hash", snap, 8)) == dict.fromkeys("abc", "low")
    C.append_batch(rows(spark, "bd", "high", 2), target, "content_hash")     # the batch job, once more
    C.append_batch(rows(spark, "b", "benign", 1), target, "content_hash")    # an older enrichment loses
    want = {"a": "low", "b": "high", "c": "low", "d": "high"}
    assert state(C.read_latest(spark, target, "content_hash", snap)) == want == state(C.read_latest(spark, target, "content_hash"))
    assert state(C.compact(spark, target, "content_hash", snap)) == want
    assert state(C.read_latest(spark, target, "content_hash", snap)) == want
    # a batch that was folded is tried again: its folder is a new attempt
    C.write_batch(rows(spark, "ce", "medium", 3), target, C.BATCH_JOB, 0, "content_hash")
    want |= {"c": "medium", "e": "medium"}
    assert state(C.read_latest(spark, target, "content_hash", snap)) == want
    assert state(C.compact(spark, target, "content_hash", snap)) == want
    assert C.last_generation(spark, snap)[0] == 2
    assert state(C.compact(spark, target, "content_hash", snap)) == want and C.last_generation(spark, snap)[0] == 2   # nothing new


def test_only_touched_buckets_are_written(spark, paths):
    target, snap = paths
    C.append_batch(rows(spark, [str(k) for k in range(200)], "low", 1), target, "content_hash")
    C.compact(spark, target, "content_hash", snap, 16)
    C.append_batch(rows(spark, ["7"], "high", 2), target, "content_hash")
    out = C.compact(spark, target, "content_hash", snap)
    _, at = C.last_generation(spark, snap)
    assert sorted(at.values()) == [0] * 15 + [1]
    assert state(out) == {str(k): "high" if k == 7 else "low" for k in range(200)}
    written = spark.read.parquet(f"{snap}/rows/gen=1")
    assert 1 <= written.count() < 200 / 4 and written.select("bucket").distinct().count() == 1


def test_a_run_that_died_is_written_again(spark, paths):
    target, snap = paths
    C.append_batch(rows(spark, "ab", "low", 1), target, "content_hash")
    C.compact(spark, target, "content_hash", snap, 4)
    rows(spark, "xyz", "high", 9).withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{snap}/rows/gen=1")   # no manifest
    C.append_batch(rows(spark, "b", "medium", 2), target, "content_hash")
    want = {"a": "low", "b": "medium"}
    assert state(C.read_latest(spark, target, "content_hash", snap)) == want
    assert state(C.compact(spark, target, "content_hash", snap)) == want


def test_no_snapshot_yet_and_null_keys(spark, paths):
    target, snap = paths
    C.append_batch(rows(spark, "ab", "low", 1), target, "content_hash")
    assert state(C.read_latest(spark, target, "content_hash", snap)) == {"a": "low", "b": "low"}
    C.append_batch(rows(spark, "n", "low", 1).withColumn("content_hash", F.lit(None).cast("string")), target, "content_hash")
    C.compact(spark, target, "content_hash", snap, 4)
    C.append_batch(rows(spark, "m", "high", 2).withColumn("content_hash", F.lit(None).cast("string")), target, "content_hash")
    assert state(C.read_latest(spark, target, "content_hash", snap)) == {"a": "low", "b": "low", "m": "high"}


def test_folded_folders_are_not_read(spark, paths):
    target, snap = paths
    for day in (1, 2):
        C.append_batch(rows(spark, "ab", "low", day), target, "content_hash")
        C.compact(spark, target, "content_hash", snap, 4)
    C.append_batch(rows(spark, "c", "high", 3), target, "content_hash")
    new = C.folders(spark, target) - C.folded(spark, snap, 1)
    assert [f[:2] for f in new] == [("batch", 2)]
    assert len(C.read_table(spark, target).filter(C.in_folders(new)).select(F.input_file_name()).distinct().collect()) == 1


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def exchanged(df):
    """The columns that each shuffle carries."""
    return [line.split(": [", 1)[1] for node in plan(df).split("\n\n") if re.match(r"\(\d+\) Exchange", node.strip()) for line in node.splitlines() if line.startswith("Input")]


def test_only_rows_of_keys_that_come_again_are_compared(spark, monkeypatch):
    once = rows(spark, "abcdef", "low", 1)
    single = C.one_per_key(once, "content_hash")
    assert state(single) == dict.fromkeys("abcdef", "low") and not exchanged(single)
    null = rows(spark, "n", "low", 1).withColumn("content_hash", F.lit(None).cast("string"))
    both = once.unionByName(rows(spark, "ab", "high", 2)).unionByName(rows(spark, "b", "medium", 1)).unionByName(null).unionByName(null.withColumn("threat_severity", F.lit("high")).withColumn("id", F.lit("m")))
    want = dict.fromkeys("cdef", "low") | {"a": "high", "b": "high", "m": "high"}
    assert state(C.one_per_key(both, "content_hash")) == want == state(C.one_per_key(both, "content_hash", count_first=False))
    monkeypatch.setattr(C, "BROADCAST_KEYS", 2)   # three keys come again
    assert state(C.one_per_key(both, "content_hash")) == want


def test_rows_are_compared_where_they_are_dealt(spark):
    both = rows(spark, "abc", "low", 1).unionByName(rows(spark, "bc", "high", 2))
    dealt = both.withColumn("part", F.pmod(F.xxhash64("content_hash"), F.lit(16))).repartition("part")
    latest = dedupe_latest(dealt, "content_hash", [("enrichment_timestamp", False)], within="part")
    assert len(exchanged(latest)) == 1 and latest.columns == both.columns
    assert state(latest) == {"a": "low", "b": "high", "c": "high"}


def test_narrow_reads_shuffle_no_wide_columns(spark, paths):
    target, snap = paths
    text = F.concat(F.lit("text of "), F.col("id"))
    C.append_batch(rows(spark, "abc", "low", 1).withColumn("text", text), target, "content_hash")
    C.compact(spark, target, "content_hash", snap, 4)
    C.append_batch(rows(spark, "bd", "high", 2).withColumn("text", text), target, "content_hash")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        out = C.read_latest(spark, target, "content_hash", snap).select("id", "threat_severity")
        carried = exchanged(out)
        assert carried and not any("text" in columns for columns in carried)
        assert state(out) == {"a": "low", "b": "high", "c": "low", "d": "high"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
