"""The corpus pipeline over a small table, and its parts in order."""

import zlib

import duckdb
import numpy as np

import __spark_entry__ as E
import corpus_pipeline
from contentrisk.llm import decontamination, queries, simhash_dedup, toxicity
from contentrisk.llm.common import read
from tests.conftest import SF_SMALL
from tools.check_oracle import canon


def test_stages_keep_columns_and_take_effect(spark):
    docs = read(spark, SF_SMALL, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == columns, name
        now = [r.doc_id for r in out.select("doc_id").collect()]
        if k == 1:
            comp = simhash_dedup.near_duplicates(docs, queries.SHINGLE_WORDS, queries.MAX_BITS).collect()
            assert sorted(now) == sorted({r.component_id for r in comp})
        if k == 2:
            leak = {r.doc_id for r in decontamination.contaminated(docs, read(spark, SF_SMALL, "benchmark")).collect()}
            assert set(now) == ids - leak
        if k == 3:
            assert set(now) == ids and len(now) > len(ids)
        assert set(now) <= ids
        docs, ids = out, set(now)
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {d for r in rows for d in r.doc_ids} == ids


def test_empty_documents(spark):
    docs = read(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_mixing_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    cur = con.execute(E.oracle_sql()["op10_mixing"])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    df = queries.op10_mixing(spark, SF_SMALL)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, want)


def test_held_out_accuracy(spark):
    """Both classifiers learn from other rows than they are judged on, at a size with enough of them."""
    sf = SF_SMALL.replace("0.001", "0.1")
    labels = {r.doc_id: r for r in read(spark, sf, "labels").collect()}
    tox = queries.op1_toxicity(spark, sf).select("doc_id", "held_out", "predicted").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in tox)
    own = [(r.predicted, labels[r.doc_id].toxic) for r in tox if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in own]) > 0.97
    good = queries.op4_quality(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in good)
    own = [(r.predicted, labels[r.doc_id].quality) for r in good if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in own]) > 0.97


def test_all_are_registered():
    names = set(E.queries())
    assert {"pipeline"} | {next(n for n in names if n.startswith(f"op{k}_")) for k in range(1, 11)} <= names
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and toxicity.SAMPLE[0] < 10_000
