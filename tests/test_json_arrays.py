"""JSON arrays read by many tasks equal Spark's multiLine reader."""

import json
import os
import random

import pytest

from contentrisk.schemas import TEXT_LANDING
from contentrisk.session import scratch_path
from contentrisk.sources import json_arrays as J
from contentrisk.sources.landing import scan_text_json

ODD = ["}", "{", "]", '"', "\\\\", '\\"}', "{}[]", "}{" * 40, "\u00e9\u4f60\U0001f600", "\n\t", "", "a" * 300, '\\\\" , {"x": [', "\\u007d"]


def records(n, seed=0):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(ODD + list("abc ")) for _ in range(rng.randint(0, 12)))
    return [{"id": str(i), "source": text(), "title": text(), "text": text(), "url": None, "timestamp": "2024", "author": text(),
             "metadata": {"k": text(), text(): "v", "n": "[1, {}]"}} for i in range(n)]


def canon(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


@pytest.fixture
def small_splits(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    spark.conf.set(keys[0], "700")
    spark.conf.set(keys[1], "1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_equals_the_multi_line_reader(spark, small_splits, monkeypatch):
    path = scratch_path(spark, "arrays").replace("file:", "")
    shapes = [dict(indent=2), dict(), dict(separators=(",", ":"), ensure_ascii=False), dict(indent=1, ensure_ascii=False)]
    for k, shape in enumerate(shapes):
        with open(os.path.join(path, f"{k}.json"), "w", encoding="utf-8") as f:
            json.dump(records(60, k), f, **shape)
    for name, body in {"one.json": json.dumps(records(1, 9)[0], indent=3), "empty.json": "[]", "blank.json": " \n", "nested.json": json.dumps([{"id": "n", "metadata": {"a": "b"}, "other": [{"id": "no"}, [{}]]}])}.items():
        with open(os.path.join(path, name), "w", encoding="utf-8") as f:
            f.write(body)
    want = canon(spark.read.schema(TEXT_LANDING).option("multiLine", True).json(f"{path}/[0-9none]*.json").filter("id IS NOT NULL"))
    assert len(want) == 4 * 60 + 2
    assert J.scan_pieces(spark, path).select("path", "start").distinct().count() > 60   # one file: many splits
    assert canon(scan_text_json(spark, path, multi_line=True)) == want
    monkeypatch.setattr(J, "BROADCAST_SPLITS", 0)
    assert canon(J.scan_json_arrays(spark, path, TEXT_LANDING)) == want


def test_a_record_longer_than_many_splits(spark, small_splits):
    path = scratch_path(spark, "long").replace("file:", "")
    rows = records(3)
    rows[1]["text"] = "}" * 5000 + "x" * 9000 + '"{' * 3000
    with open(os.path.join(path, "a.json"), "w") as f:
        json.dump(rows, f)
    assert sorted(r.text for r in J.scan_json_arrays(spark, path, TEXT_LANDING).collect()) == sorted(r["text"] for r in rows)


def test_arrays_are_landed_by_the_tasks_that_hold_the_records(spark, monkeypatch):
    from contentrisk.plans import queries as Q
    from contentrisk.sources.landing import land_json_arrays

    path = scratch_path(spark, "landed").replace("file:", "")
    rows = [r | {"id": f"{k:03d}"} for k, r in enumerate(records(40))]
    land_json_arrays(spark.createDataFrame(rows, TEXT_LANDING).repartition(5), path)
    files = [f for f in os.listdir(path) if f.endswith(".txt") and os.path.getsize(f"{path}/{f}")]
    assert len(files) == 5
    landed = [r for f in files for r in json.load(open(f"{path}/{f}", encoding="utf-8"))]
    assert sorted(landed, key=lambda r: r["id"]) == rows
    assert canon(scan_text_json(spark, path, multi_line=True)) == sorted(json.dumps(r, sort_keys=True) for r in rows)
    # the query's files are as many as its tasks, not two whatever the input
    made = []
    monkeypatch.setattr(Q, "scratch_path", lambda s, name: made.append(scratch_path(s, name)) or made[-1])
    assert Q.q_scan_text_arrays(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert len(spark.read.text(made[0]).inputFiles()) >= spark.sparkContext.defaultParallelism
