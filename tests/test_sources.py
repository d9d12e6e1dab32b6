import datetime as dt
import json

from pyspark.sql import functions as F

from contentrisk.functions.dictionary import REFERENCE_DICTIONARY
from contentrisk.operators.extract import extract_text
from contentrisk.operators.ingest import ingest_text
from contentrisk.session import scratch_path
from contentrisk.sources.landing import (
    collect_dictionary,
    keyword_lookup,
    keywords_per_category,
    load_dictionary,
    scan_text_json,
)
from contentrisk.sources.normalize import (
    normalize_rss,
    normalize_social,
    normalize_wiki,
    rejected_payloads,
    parse_event_ts,
    valid_content,
)


def _write(path, name, obj):
    with open(f"{path}/{name}", "w", encoding="utf-8") as f:
        json.dump(obj, f)


def test_dictionary_file_roundtrip(spark):
    path = scratch_path(spark, "dict")
    _write(path, "threat_mappings.json", REFERENCE_DICTIONARY)
    d = load_dictionary(spark, f"{path}/threat_mappings.json", as_of="2024-01-31")
    assert d.count() == 6
    assert keyword_lookup(d).count() == 86 + 0  # distinct (category, keyword) pairs
    counts = {r.category: r.keyword_count for r in keywords_per_category(d).collect()}
    assert counts["terrorism"] == 17 and counts["drugs"] == 14
    back = collect_dictionary(d)
    assert sum(t.kind == "pattern" for t in back.terms()) == 36


def test_landing_scan_ignores_statistics_file(spark):
    path = scratch_path(spark, "landing")
    recs = [{"id": "wiki_1", "source": "wikipedia", "title": "T", "text": "plan the attack",
             "timestamp": "2024-01-01T00:00:00", "metadata": {"type": "encyclopedia", "n": 3}},
            {"id": "news_1", "source": "h", "title": "x", "text": "",
             "timestamp": "Mon, 01 Jan 2024 10:00:00 GMT"}]
    _write(path, "text_data_1.json", recs)
    _write(path, "collection_stats.json", {"total_samples": 2, "sources": {"wikipedia": 1}})
    df = scan_text_json(spark, f"{path}/*.json", multi_line=True)
    assert df.columns == ["id", "source", "title", "text", "url", "timestamp", "author", "metadata"]
    raw = ingest_text(df, as_of="2024-01-31")
    assert sorted(r.id for r in raw.collect()) == ["news_1", "wiki_1"]   # stats row: null id, dropped
    meta = raw.where("id = 'wiki_1'").first().metadata
    assert meta == {"type": "encyclopedia", "n": "3"}                     # map<string,string>


def test_mixed_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("Mon, 01 Jan 2024 10:00:00 GMT",),
                                ("01 Jan 2024 10:00:00 +0000",), ("garbage",)], "s string")
    got = [r.t for r in df.select(parse_event_ts(F.col("s")).alias("t")).collect()]
    assert got[:3] == [dt.datetime(2024, 1, 1, 10, 0)] * 3 and got[3] is None


def test_normalisers(spark):
    wiki = spark.createDataFrame([('{"pageid": 5, "title": "A"}',)], "payload string")
    w = normalize_wiki(wiki, collected_at="2024-01-31").first()
    assert (w.id, w.text, w.url, w.metadata["description"]) == ("wiki_5", "", "", "")
    feed = ('<rss><channel><item><title>a</title><link>http://x/1</link></item>'
            '<item><title>b</title><link>http://x/2</link><author>z</author></item></channel></rss>')
    feeds = spark.createDataFrame([(feed, "https://feeds.example.com/rss.xml")], "payload string, feed_url string")
    items = normalize_rss(feeds, collected_at="2024-01-31", max_items=1).collect()
    assert len(items) == 1 and items[0].source == "feeds.example.com" and items[0].author == "Unknown"
    assert items[0].metadata["category"] == "general" and items[0].id.startswith("news_")
    listing = json.dumps({"data": {"children": [
        {"data": {"id": "p1", "title": "T", "selftext": "", "created_utc": 0}},
        {"data": {"id": "p2", "title": "U", "selftext": "body", "score": 3, "is_video": True}}]}})
    posts = normalize_social(spark.createDataFrame([(listing, "news")], "payload string, subreddit string")).collect()
    assert [(p.id, p.text, p.source) for p in posts] == [("reddit_p1", "T", "reddit_r_news"),
                                                         ("reddit_p2", "body", "reddit_r_news")]
    assert posts[1].metadata["is_video"] == "true" and posts[0].timestamp == "1970-01-01T00:00:00"


def test_unreadable_payloads_are_told_apart(spark):
    bad = [(None,), ("",), (" ",), ("not json{",), ('{"pageid": 1',), ("5",)]
    wiki = spark.createDataFrame([*bad, ('{"pageid": 7, "title": "A", "extract": "b"}',), ("{}",)], "payload string")
    assert sorted(r.id for r in normalize_wiki(wiki, collected_at="2024-01-31").collect()) == ["wiki_", "wiki_7"]   # {}: an article without fields
    got = [(r.payload, r.kind, r.reason) for r in rejected_payloads(wiki, "wiki").collect()]
    assert got == [(p, "wiki", "no payload" if not (p or "").strip() else "unreadable") for p, in bad]
    listings = spark.createDataFrame([(p, "s") for p, in [*bad, ('{"error": 429}',), ('{"data": {"children": []}}',)]], "payload string, subreddit string")
    assert normalize_social(listings).count() == 0
    assert [r.reason for r in rejected_payloads(listings, "social").collect()] == ["no payload"] * 3 + ["unreadable"] * 3 + ["no items"]
    feeds = spark.createDataFrame([(p, "u") for p in (None, "<rss><channel><item>", "<rss><error/></rss>", "junk", "<rss><channel><item><link>l</link></item></channel></rss>")], "payload string, feed_url string")
    assert normalize_rss(feeds, collected_at="2024-01-31").count() == 1
    assert [r.reason for r in rejected_payloads(feeds, "rss").collect()] == ["no payload", "unreadable", "no items", "unreadable"]


def test_content_validity_and_pluggable_extractor(spark):
    png = bytes.fromhex("89504E470D0A1A0A") + b"rest"
    df = spark.createDataFrame([("a", png), ("b", b"\x00\x01junk"), ("c", b"<!DOCTYPE html><p>x</p>")],
                               "id string, content binary")
    assert [r.id for r in valid_content(df).collect()] == ["a"]
    assert sorted(r.id for r in valid_content(df, kinds=("png", "html")).collect()) == ["a", "c"]

    def fragile(b):
        if b.startswith(b"\x00"):
            raise ValueError("unreadable")
        return "  text\n from   " + b[:3].hex()

    out = {r.id: r.extracted_text for r in extract_text(df, "content", fragile).collect()}
    assert out["b"] == "" and out["a"] == "text from 89504e"
    html = {r.id: r.extracted_text for r in extract_text(df.where("id = 'c'"), "content", "html").collect()}
    assert html["c"] == "x"


def test_binary_scan_catalog_and_json_landing(spark):
    import hashlib
    import os

    from contentrisk.sources.landing import land_json, scan_binary_files
    from contentrisk.sources.normalize import collection_stats_images, image_catalog

    path = scratch_path(spark, "bin")
    gif = b"GIF89a" + b"\x00" * 10
    for name, data in (("a.gif", gif), ("b.txt", b"hello")):
        with open(os.path.join(path, name), "wb") as f:
            f.write(data)
    files = scan_binary_files(spark, path, glob="*.gif").withColumn("source", F.lit("picsum"))
    cat = image_catalog(files).collect()
    md5 = hashlib.md5(gif).hexdigest()
    assert [(r.id, r.file_size, r.content_md5) for r in cat] == [(f"picsum_{md5[:8]}", 16, md5)]
    stats = collection_stats_images(image_catalog(files)).first()
    assert stats.total_images == 1 and stats.picsum == 1 and stats.placeimg == 0

    out = scratch_path(spark, "land")
    recs = spark.createDataFrame([("1", "s", "t", "ü text")], "id string, source string, title string, text string")
    land_json(recs, out)
    back = scan_text_json(spark, out).first()
    assert back.text == "ü text" and back.url is None


def test_attach_content_then_extract(spark):
    import os

    from contentrisk.functions.dictionary import analysis_dictionary
    from contentrisk.operators.enrich import enrich_images
    from contentrisk.operators.extract import attach_content
    from contentrisk.sources.landing import scan_binary_files

    folder = scratch_path(spark, "imgs")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    with open(os.path.join(local, "a.bin"), "wb") as f:
        f.write(b"TXT:you idiot")
    meta = spark.createDataFrame(
        [("a", "s", f"{local}/a.bin", "h1"), ("b", "s", f"{local}/missing.bin", "h2")],
        "id string, source string, filepath string, image_hash string")
    joined = attach_content(meta, scan_binary_files(spark, local))
    ocr = lambda b: b[4:].decode("utf-8") if b.startswith(b"TXT:") else ""
    out = {r.id: (r.extracted_text, r.ocr_success, r.threat_severity)
           for r in enrich_images(joined, analysis_dictionary(), extractor=ocr).collect()}
    assert out == {"a": ("you idiot", True, "medium"), "b": ("", False, "benign")}


def test_recent_scans_skip_files_and_row_groups(spark):
    from contentrisk.operators.tables import write_clustered
    from contentrisk.sources.normalize import recent, with_event_time

    rows = spark.range(4000).selectExpr("cast(id AS string) AS id", "date_format(timestamp_seconds(1704067200 + id * 600), \"yyyy-MM-dd'T'HH:mm:ss\") AS timestamp")
    mixed = rows.unionByName(spark.createDataFrame([("x", "no time"), ("y", "Sun, 28 Jan 2024 10:00:00 GMT"), ("z", None)], "id string, timestamp string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = write_clustered(with_event_time(mixed).repartition(5), scratch_path(spark, "clustered"), "event_time")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    late = recent(table, 2, "2024-01-28")
    assert late.count() == 1 + sum(1704067200 + k * 600 >= 1706227200 for k in range(4000)) and "y" in {r.id for r in late.collect()}
    files = table.select(F.input_file_name()).distinct().count()
    assert files >= 6 and late.select(F.input_file_name()).distinct().count() <= 2      # rows of the range lie together
    p = late._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time," in p
