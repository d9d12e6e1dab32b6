from contentrisk.plans import queries as Q
from contentrisk.plans.catalog import register_table, register_views, run_all, save_results
from contentrisk.session import scratch_path
from tests.conftest import SF_SMALL


def test_views_run_all_and_export(spark):
    text, images = Q.enriched_tables(spark, SF_SMALL)
    register_views(spark, text, images)
    n = spark.sql("SELECT COUNT(*) AS n FROM text_enriched WHERE is_threat").first().n
    assert n == text.where("is_threat").count()
    results = run_all(text, images, as_of="2024-01-31")
    assert len(results) == 10
    out = scratch_path(spark, "export")
    paths = save_results({"daily_threat_ratio": results["daily_threat_ratio"]}, out, stamp="t")
    back = spark.read.option("header", True).csv(paths["daily_threat_ratio"])
    assert back.count() == results["daily_threat_ratio"].count()
    assert "threat_percentage" in back.columns


def test_external_table(spark):
    text, _ = Q.enriched_tables(spark, SF_SMALL)
    path = text.inputFiles()[0].rsplit("/", 1)[0]
    register_table(spark, "te_ext", path)
    assert spark.table("te_ext").count() == text.count()
