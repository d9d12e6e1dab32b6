"""Insert-only loads through the filter beside the table equal an exact anti-join."""

import re

import pytest
from pyspark.sql import functions as F

from contentrisk.operators import key_filter as K
from contentrisk.operators.ingest import load_raw
from contentrisk.session import scratch_path


def keyed(spark, ids, source="s"):
    return spark.createDataFrame([(F_, source) for F_ in map(str, ids)], "id string, source string").select(F.md5("id").alias("k"), "source", "id")


def test_loads_add_new_keys_once(spark, monkeypatch):
    monkeypatch.setattr(K, "LEAST_ARRAY", 2)          # the array has to grow
    path = scratch_path(spark, "raw")
    for a, z in [(0, 50), (0, 50), (30, 400), (0, 400), (395, 405)]:
        load_raw(keyed(spark, range(a, z)).unionByName(keyed(spark, range(a, z))), path, "k")
        got = spark.read.parquet(path)
        assert got.count() == got.select("k").distinct().count() == max(z, got.count())
    assert got.count() == 405
    # a key is one whatever its row's source
    load_raw(keyed(spark, [7, 900], "t"), path, "k")
    assert spark.read.parquet(path).filter("source = 't'").select("id").first().id == "900"
    array, keys, files = K.current(spark, path)
    assert keys == 405 and 2 ** array * K.KEYS_A_WORD >= 405
    assert set(spark.read.parquet(path).inputFiles()) > files      # the last load's file is noted by the next


def test_rows_written_past_the_filter_count(spark):
    """A load that died before it was noted, or files from elsewhere: the next load sees them."""
    path = scratch_path(spark, "raw")
    load_raw(keyed(spark, range(10)), path, "k")
    keyed(spark, range(10, 20)).write.mode("append").partitionBy("source").parquet(path)
    load_raw(keyed(spark, range(25)), path, "k")
    assert spark.read.parquet(path).count() == 25
    # keys and bits that were written twice change nothing
    keys = spark.read.schema(K.KEYS).parquet(K.beside(path, "keys"))
    keys.write.mode("append").partitionBy("bucket").parquet(K.beside(path, "keys"))
    load_raw(keyed(spark, range(30)), path, "k")
    assert spark.read.parquet(path).count() == 30


def test_only_buckets_of_possible_keys_are_read(spark):
    path = scratch_path(spark, "raw")
    load_raw(keyed(spark, range(3000)), path, "k")
    table = spark.read.parquet(path)
    new = keyed(spark, range(10_000, 10_040)).select("k")
    array = K.note_files(spark, table, path, "k")
    assert K.known_keys(spark, table, path, new, "k").count() == 0
    known = K.known_keys(spark, table, path, keyed(spark, [5, 20_000]).select("k"), "k")
    assert [r.k for r in known.collect()] == [keyed(spark, [5]).first().k]
    words = spark.read.schema(K.FILTER).parquet(K.beside(path, "filter")).filter(F.col("array") == array)
    assert words.count() < 3000 and words.agg(F.max(F.bit_count("bits"))).first()[0] < 40
    passed = (keyed(spark, range(50_000, 80_000)).select(F.xxhash64("k").alias("h")).withColumns({"word": K.word_of(F.col("h"), array), "own": K.bits_of("h")})
              .join(words.groupBy("word").agg(F.bit_or("bits").alias("bits")), "word").filter("(bits & own) = own").count())
    assert passed < 30_000 / 100
