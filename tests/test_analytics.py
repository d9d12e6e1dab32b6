import datetime as dt

from contentrisk.plans import analytics as A

T0 = dt.datetime(2024, 1, 28, 10, 0, 0)
ENRICHED = ("id string, source string, title string, text string, filepath string, extracted_text string, "
            "is_threat boolean, threat_severity string, threat_categories array<string>, "
            "enrichment_timestamp timestamp, ocr_success boolean, text_length int")


def frame(spark, rows):
    return spark.createDataFrame(rows, ENRICHED)


def row(i, src, threat, sev="benign", cats=(), ts=T0, title="t", ocr=False, length=0):
    return (i, src, title, "body " + i, "/p/" + i, "x" if ocr else "", threat, sev, list(cats), ts, ocr, length)


def test_ratio_null_flags_and_zero_benign(spark):
    text = frame(spark, [row("a", "s1", True, "low", ["c"]), row("b", "s1", None),
                         row("c", "s2", True, "low", ["c"])])
    images = frame(spark, [row("i", "s1", False)])
    out = {(r.source, r.total_count): r for r in A.daily_threat_ratio(text, images).collect()}
    s1 = out[("s1", 2)]
    assert (s1.threat_count, s1.benign_count) == (1, 0)        # the null flag counts only in the total
    assert s1.threat_to_benign_ratio is None                    # benign_count = 0 -> null
    assert s1.threat_percentage == 50.0
    assert out[("s1", 1)].benign_count == 1                     # same source in the image branch: its own row
    assert out[("s2", 1)].threat_percentage == 100.0


def test_latest_threats_tie_breaks_by_id_and_branches(spark):
    text = frame(spark, [row("b", "s", True, "low", ["c"]), row("a", "s", True, "low", ["c"]),
                         row("old", "s", True, "low", ["c"], ts=dt.datetime(2024, 1, 1))])
    images = frame(spark, [row("img", "s", True, "high", ["c"], ocr=True)])
    out = A.latest_threats(text, images, "2024-01-31").collect()
    assert [(r.content_type, r.id) for r in out] == [("image", "img"), ("text", "a")] or \
        sorted((r.content_type, r.id) for r in out) == [("image", "img"), ("text", "a")]
    img = next(r for r in out if r.content_type == "image")
    assert img.preview == "Image: x..." and img.image_path == "/p/img"


def test_recency_filter_excludes_old(spark):
    text = frame(spark, [row("old", "s", True, "low", ["c"], ts=dt.datetime(2024, 1, 23, 23, 59))])
    images = frame(spark, [])
    assert A.latest_threats(text, images, "2024-01-31").count() == 0


def test_severity_percentages_and_rank(spark):
    text = frame(spark, [row("a", "s1", True, "low", ["x", "y"]), row("b", "s1", True, "high", ["x"]),
                         row("c", "s2", True, "high", ["x"]), row("d", "s2", False)])
    images = frame(spark, [])
    dist = {r.threat_severity: (r["count"], r.percentage) for r in A.severity_distribution(text, images).collect()}
    assert dist == {"low": (1, 33.33), "high": (2, 66.67)}
    top = {(r.threat_category, r.source): (r.threat_count, r.source_rank)
           for r in A.top_sources(text, images).collect()}
    assert top[("x", "s1")] == (2, 1) and top[("x", "s2")] == (1, 2) and top[("y", "s1")] == (1, 1)


def test_ocr_rates(spark):
    images = frame(spark, [row("1", "s", False, ocr=True, length=10), row("2", "s", False, ocr=False)])
    r = A.ocr_success_by_source(images).collect()[0]
    assert (r.total_images, r.ocr_success_count, r.ocr_success_rate) == (2, 1, 50.0)
    d = A.ocr_success_daily(images).collect()[0]
    assert d.avg_extracted_text_length == 5.0


def test_ocr_rates_on_mock_images(spark, mock_images_enriched):
    rows = {r.source: (r.total_images, r.ocr_success_count, r.ocr_success_rate)
            for r in A.ocr_success_by_source(mock_images_enriched).collect()}
    assert rows == {"unsplash": (1, 0, 0.0), "picsum": (1, 1, 100.0), "placeholder": (1, 0, 0.0)}
    daily = A.ocr_success_daily(mock_images_enriched).collect()
    assert sorted((r.source, r.avg_extracted_text_length) for r in daily) == [
        ("picsum", 10.0), ("placeholder", 0.0), ("unsplash", 0.0)]


def test_null_and_empty_category_arrays(spark):
    text = frame(spark, [row("a", "s", True, "low", ["x"]), ("n", "s", "t", "b", "/p", "", True, "low", None,
                                                             T0, False, 0),
                         row("e", "s", True, "low", [])])
    images = frame(spark, [])
    got = [(r.threat_category, r.threat_count) for r in A.daily_threat_categories(text, images).collect()]
    assert got == [("x", 1)]
    assert A.top_sources(text, images).count() == 1
