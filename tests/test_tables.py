import datetime as dt

from contentrisk.operators.ingest import ingest_text, load_raw
from contentrisk.operators.tables import merge_insert_only, merge_upsert, write_table
from contentrisk.session import scratch_path

S = "k string, v string, ts timestamp"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_insert_only_dedupes_inside_batch(spark):
    tgt = spark.createDataFrame([("a", "old", T1)], S)
    src = spark.createDataFrame([("a", "new", T2), ("b", "x", T1), ("b", "x", T1)], S)
    out = sorted(tuple(r) for r in merge_insert_only(tgt, src, "k").collect())
    assert out == [("a", "old", T1), ("b", "x", T1)]


def test_upsert_latest_wins_and_is_idempotent(spark):
    tgt = spark.createDataFrame([("a", "old", T1), ("c", "keep", T1)], S)
    src = spark.createDataFrame([("a", "mid", T1), ("a", "new", T2), ("b", "ins", T2)], S)
    once = merge_upsert(tgt, src, "k", [("ts", False), ("v", True)])
    twice = merge_upsert(once, src, "k", [("ts", False), ("v", True)])
    exp = [("a", "new", T2), ("b", "ins", T2), ("c", "keep", T1)]
    assert sorted(tuple(r) for r in once.collect()) == exp
    assert sorted(tuple(r) for r in twice.collect()) == exp


def test_load_raw_is_idempotent(spark):
    landing = spark.createDataFrame(
        [("1", "s", None, "hello", None, "2024-01-01T00:00:00", None, None),
         ("2", "s", None, None, None, "2024-01-01T00:00:00", None, None),      # no text: dropped
         ("1", "s", None, "hello", None, "2024-01-01T00:00:00", None, None)],  # duplicate: once
        "id string, source string, title string, text string, url string, timestamp string, "
        "author string, metadata map<string,string>")
    raw = ingest_text(landing, as_of="2024-01-31")
    path = scratch_path(spark, "test_raw")
    load_raw(raw, path, "content_hash")
    load_raw(raw, path, "content_hash")
    out = spark.read.parquet(path)
    assert out.count() == 1
    assert out.first().content_hash == spark.sql("select md5('1||hello||s') h").first().h


def test_a_written_table_is_not_read_for_its_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(id AS string) AS `a b`", "array(struct(id AS x)) AS s", "map('k', id) AS m")
    spark.sparkContext.setJobGroup("written", "")
    try:
        out = write_table(df, "written")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("written")) == 1      # the write
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.schema == spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0]).schema
    assert out.orderBy("id").collect() == df.orderBy("id").collect()
    assert write_table(df.limit(0), "none").collect() == []
