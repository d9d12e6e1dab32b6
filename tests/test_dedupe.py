"""dedupe_latest and the merges on it: results and plan shape."""

import datetime as dt

from contentrisk.operators.tables import dedupe_latest, merge_upsert, row_hash

SCHEMA = "k string, text string, ts timestamp, m map<string,string>"
DAY = [dt.datetime(2024, 1, d) for d in range(1, 4)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_row_of_each_key(spark):
    rows = [("a", "old", DAY[0], {}), ("a", "new", DAY[2], {"x": "1", "y": None}), ("a", "new", DAY[2], {"y": None, "x": "1"}),
            ("a", "undated", None, None), ("b", None, None, None), ("", "t", DAY[1], {})]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((r.k, r.text, r.ts) for r in dedupe_latest(df, "k", [("ts", False)]).collect())
    assert got == [("", "t", DAY[1]), ("a", "new", DAY[2]), ("b", None, None)]
    assert dedupe_latest(df.limit(0), "k").collect() == []


def test_ties_do_not_depend_on_partitions(spark):
    rows = [("a", f"t{i}", DAY[0], {}) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    picked = {dedupe_latest(df.repartition(n), "k", [("ts", False)]).first().text for n in (1, 3, 7)}
    assert len(picked) == 1


def test_copies_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "x", DAY[0], {})], SCHEMA)
    for out in (dedupe_latest(df, "k", [("ts", False)]), merge_upsert(df, df.unionAll(df), "k", [("ts", False)])):
        plan = plan_of(out)
        assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_maps_at_any_depth_and_columns_of_internal_names(spark):
    schema = "k string, __row_hash int, __rn int, a array<map<string,int>>, s struct<m: map<string,array<map<int,int>>>, x: int>, n map<string,map<string,int>>"
    rows = [("a", 1, 2, [{"x": 1, "y": 2}, None], ({"q": [{1: 2}]}, 3), {"o": {"p": 1}}), ("a", 1, 2, [{"y": 2, "x": 1}, None], ({"q": [{1: 2}]}, 3), {"o": {"p": 1}}),
            ("b", None, None, None, None, None), ("b", None, None, None, (None, 1), None)]
    df = spark.createDataFrame(rows, schema)
    out = dedupe_latest(df, "k")
    assert out.columns == df.columns and out.count() == 2
    assert df.select(row_hash(df).alias("h")).distinct().count() == 3      # the order of a map's entries doesn't matter
    assert merge_upsert(df.limit(0), df, "k", [("__rn", False)]).count() == 2
