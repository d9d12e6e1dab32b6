"""Plan shapes that matter at scale."""

from pyspark.sql import functions as F

from contentrisk.operators.tables import dedupe_latest
from contentrisk.plans import analytics as A
from contentrisk.plans import queries as Q
from tests.conftest import SF_SMALL


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")   # no truncated scan metadata
    return df._jdf.queryExecution().executedPlan().toString()


def test_analytics_push_filters_and_prune(spark):
    text, images = Q.enriched_tables(spark, SF_SMALL)
    p = plan(A.daily_threat_categories(text, images))
    assert "PushedFilters: [IsNotNull(is_threat), EqualTo(is_threat,true)" in p
    assert "ReadSchema: struct<source:string,is_threat:boolean,enrichment_timestamp:timestamp," \
           "threat_categories:array<string>>" in p           # only the four needed columns
    for name, fn in A.ANALYTICS.items():
        p = plan(fn(text, images))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_latest_per_category_is_cut_before_the_shuffle(spark):
    text, images = Q.enriched_tables(spark, SF_SMALL)
    p = plan(A.latest_threats(text, images))
    assert p.count("WindowGroupLimit") == 4    # of each table: one row a category and task, then one a category
    assert "SortAggregate [threat_category" not in p and "preview" not in p.split("WindowGroupLimit")[-1].split("Exchange")[0]


def test_rank_orders_counts_not_sources(spark):
    text, images = Q.enriched_tables(spark, SF_SMALL)
    p = plan(A.top_sources(text, images))
    window = [line for line in p.splitlines() if " Window " in line or line.strip().startswith("+- Window")]
    assert window and all("source#" not in line.split("windowspecdefinition")[1] for line in window)
    assert "rank(" not in p


def test_dedupe_orders_by_narrow_columns_and_cuts_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", 1), ("k", 2)], "k string, v int")
    p = plan(dedupe_latest(df, "k", [("v", False)]))
    assert p.count("WindowGroupLimit") == 2 and "Aggregate" not in p   # one per task, then one per key
    assert dedupe_latest(df, "k", [("v", False)]).first().v == 2


def test_recency_filter_reaches_the_scan(spark):
    text, images = Q.enriched_tables(spark, SF_SMALL)
    p = plan(A.latest_threats(text, images, "2024-01-31"))
    assert "GreaterThanOrEqual(enrichment_timestamp,2024-01-24 00:00:00.0)" in p


def test_enrichment_has_no_python(spark):
    p = plan(Q.text_enriched(spark, SF_SMALL, engine="native").select("id", "threat_severity", F.size("detected_threats")))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_join_form_is_an_equi_join(spark):
    p = plan(Q.QUERIES["detect_threats_join"](spark, SF_SMALL))
    assert "NestedLoop" not in p and "CartesianProduct" not in p and "ArrowEvalPython" not in p
    assert "BroadcastHashJoin [gram" in p


def test_default_engine_returns_term_numbers_alone(spark):
    p = plan(Q.text_enriched(spark, SF_SMALL).select("id", "detected_threats", "threat_severity"))
    assert p.count("ArrowEvalPython") == 1 and "search(" in p
