"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the raw views of ``sources.testdata`` over the whole driver
tables; enrichment uses the published dictionary plus the corpus test
categories, with enrichment time taken from the row (deterministic).

Like the reference pipeline (enrichment job -> enriched tables -> analytics),
the analytics read *written* enriched tables: ``enriched_tables`` runs the
two enrichment jobs once per session and input folder and writes them under
the shared checkpoint folder.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.functions.dictionary import analysis_dictionary, reference_dictionary
from contentrisk.functions.matching import detect_threats_join, flatten_match_strings
from contentrisk.functions.matching_arrow import keyword_hits
from contentrisk.functions.text import url_host
from contentrisk.operators import stats
from contentrisk.operators.enrich import enrich_images, enrich_text
from contentrisk.operators.extract import extract_text
from contentrisk.operators.ingest import ingest_images, ingest_text, load_raw
from contentrisk.operators.partitioning import cores_beyond_splits, spread_for_cpu
from contentrisk.operators.prepare import fallback_enrich, harmonize_schema
from contentrisk.operators.tables import merge_insert_only, merge_upsert, read_table, write_clustered, write_table
from contentrisk.plans import analytics
from contentrisk.schemas import IMAGE_LANDING, TEXT_LANDING
from contentrisk.session import pin_utc, scratch_path
from contentrisk.sources import testdata
from contentrisk.sources.image_headers import whole_images
from contentrisk.sources.landing import dictionary_frame, keyword_lookup, land_json_arrays, scan_image_json, scan_text_json
from contentrisk.sources.normalize import (
    IMAGE_FAMILIES,
    collection_stats_images,
    collection_stats_text,
    image_catalog,
    image_landing as image_records,
    normalize_rss,
    normalize_social,
    normalize_wiki,
    recent,
    rejected_payloads,
    union_sources,
    valid_content,
    with_event_time,
)
from contentrisk.streaming.compaction import BATCH_JOB, append_batch, compact, read_latest, write_batch
from contentrisk.streaming.enrichment import start_image_enrichment, start_text_enrichment
from contentrisk.streaming.maintained import category_distribution, maintained, severity_counts, write_deltas

Query = Callable[[SparkSession, str], DataFrame]


def text_enriched(spark: SparkSession, sf_dir: str, engine: str = "arrow") -> DataFrame:
    """The enrichment plan (not materialised): text_raw -> text_enriched."""
    pin_utc(spark)
    raw = testdata.text_raw(spark, sf_dir)
    return enrich_text(raw, analysis_dictionary(), enrichment_ts=F.col("ingestion_timestamp"), engine=engine,
                       partitions=cores_beyond_splits(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def images_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment plan (not materialised): images_raw + content -> images_enriched."""
    pin_utc(spark)
    raw = testdata.images_raw(spark, sf_dir)
    return enrich_images(raw, analysis_dictionary(), enrichment_ts=F.col("ingestion_timestamp"),
                         partitions=cores_beyond_splits(spark.read.parquet(f"{sf_dir}/pages.parquet")))


_WRITTEN: dict[tuple, tuple[str, str]] = {}


def _input_key(spark: SparkSession, sf_dir: str) -> tuple:
    files = []
    for name in ("documents", "pages"):
        p = f"{sf_dir.rstrip('/')}/{name}.parquet"
        st = os.stat(p) if os.path.exists(p) else None
        files.append((p, st.st_size if st else None, st.st_mtime if st else None))
    return (spark.sparkContext.applicationId, tuple(files))


def enriched_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Written text_enriched / images_enriched tables (computed once per input)."""
    pin_utc(spark)
    key = _input_key(spark, sf_dir)
    paths = _WRITTEN.get(key)
    if paths is None or not all(os.path.exists(p.replace("file:", "")) or "://" in p for p in paths):
        paths = (scratch_path(spark, "text_enriched"), scratch_path(spark, "images_enriched"))
        write_table(text_enriched(spark, sf_dir).drop("combined_text"), "text_enriched", path=paths[0])
        write_table(images_enriched(spark, sf_dir), "images_enriched", path=paths[1])
        _WRITTEN[key] = paths
    return spark.read.parquet(paths[0]), spark.read.parquet(paths[1])


def _analytic(name: str) -> Query:
    fn = analytics.ANALYTICS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text, images = enriched_tables(spark, sf_dir)
        # the test tables end at a fixed date; live callers get the current one
        return fn(text, images, testdata.TEST_AS_OF) if name.startswith("latest_threats") else fn(text, images)

    run.__name__ = name
    return run


QUERIES: dict[str, Query] = {name: _analytic(name) for name in analytics.ANALYTICS}


# ---------------------------------------------------------------------------
# Operator-level queries (detection, enrichment, extraction, hashing).
# ---------------------------------------------------------------------------

def _joined(col: str) -> Column:
    return F.array_join(F.col(col), "|")


def q_detect_threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (document, matched category), expression form."""
    te = text_enriched(spark, sf_dir, engine="native")
    # inline_outer + a filter on the generated column: the optimizer cannot turn the
    # generator into a predicate on the (large) detection expression below it.
    rows = te.select("id", F.inline_outer("detected_threats")).where(F.col("category").isNotNull())
    return flatten_match_strings(rows)


def q_detect_threats_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows via the Arrow-batched engine."""
    pin_utc(spark)
    te = text_enriched(spark, sf_dir, engine="arrow")
    rows = te.select("id", F.inline_outer("detected_threats")).where(F.col("category").isNotNull())
    return flatten_match_strings(rows)


def q_detect_threats_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows via the broadcast term-table join."""
    pin_utc(spark)
    raw = spread_for_cpu(testdata.text_raw(spark, sf_dir), cores_beyond_splits(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    text = F.concat_ws(" ", F.col("title"), F.col("text"))
    out = detect_threats_join(raw, "id", text, analysis_dictionary())
    return flatten_match_strings(out.drop("cat_ord", "sev_rank"))


def q_threat_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    te = text_enriched(spark, sf_dir)
    total = F.aggregate("detected_threats", F.lit(0.0).cast("double"),
                        lambda acc, x: acc + x["threat_score"].cast("double"))
    return te.select("id", total.alias("threat_score"),
                     F.size("detected_threats").alias("n_categories"))


def q_threat_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_enriched(spark, sf_dir).select("id", "threat_severity", "is_threat")


def q_enrich_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    te = text_enriched(spark, sf_dir)
    return te.select("id", "source", "content_hash", "is_threat", "threat_severity",
                     _joined("threat_categories").alias("threat_categories"),
                     "enrichment_timestamp", "enrichment_id")


def q_enrich_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    ie = images_enriched(spark, sf_dir)
    return ie.select("id", "source", "filepath", "image_hash", "ocr_success", "text_length",
                     "is_threat", "threat_severity",
                     _joined("threat_categories").alias("threat_categories"),
                     "enrichment_timestamp", "enrichment_id")


def q_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    raw = spread_for_cpu(testdata.images_raw(spark, sf_dir), cores_beyond_splits(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    out = extract_text(raw, "content", "html", "extracted_text")
    return out.select("id", "extracted_text", F.length("extracted_text").alias("text_length"))


def q_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.text_raw(spark, sf_dir).select("id", "content_hash")


def q_image_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.images_raw(spark, sf_dir).select("id", "filepath", "image_hash")


QUERIES.update({
    "detect_threats": q_detect_threats,
    "detect_threats_join": q_detect_threats_join,
    "detect_threats_arrow": q_detect_threats_arrow,
    "threat_score": q_threat_score,
    "threat_severity": q_threat_severity,
    "enrich_text": q_enrich_text,
    "enrich_images": q_enrich_images,
    "extract_text": q_extract_text,
    "content_hash": q_content_hash,
    "image_hash": q_image_hash,
})


# ---------------------------------------------------------------------------
# Fallback classifiers, schema harmonisation, dictionary lookup join.
# ---------------------------------------------------------------------------

def q_fallback(variant: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = testdata.text_raw(spark, sf_dir)
        out = fallback_enrich(raw, variant, enrichment_ts=F.col("ingestion_timestamp"))
        return out.select("id", "is_threat", "threat_severity",
                          _joined("threat_categories").alias("threat_categories"),
                          _joined("detected_threats").alias("detected_threats"))
    run.__name__ = f"fallback_classifier_{variant}"
    return run


def q_harmonize_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A legacy-shaped table (has_threat, threat_level, no arrays) brought to the current schema."""
    raw = testdata.text_raw(spark, sf_dir)
    legacy = (fallback_enrich(raw, "a", enrichment_ts=F.col("ingestion_timestamp"))
              .select("id", "source", F.col("is_threat").alias("has_threat"), "enrichment_timestamp"))
    out = harmonize_schema(legacy)
    return out.select("id", "is_threat", "threat_severity",
                      _joined("threat_categories").alias("threat_categories"),
                      _joined("detected_threats").alias("detected_threats"))


def q_keyword_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per (category, keyword): one pass finds a text's keywords, their counts meet the
    keyword lookup in an equi join (both sides bounded by the dictionary)."""
    raw = spread_for_cpu(testdata.text_raw(spark, sf_dir), cores_beyond_splits(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    dictionary = analysis_dictionary()
    words = [t.term for t in dictionary.terms() if t.kind == "keyword"]
    counts = (raw.select(F.explode(keyword_hits(F.lower(F.concat_ws(" ", "title", "text")), words)).alias("keyword"))
              .groupBy("keyword").agg(F.count(F.lit(1)).alias("doc_count")))
    lookup = keyword_lookup(dictionary_frame(spark, dictionary, as_of=testdata.TEST_AS_OF))
    return (lookup.select("category", F.lower("keyword").alias("keyword")).join(counts, "keyword")
            .select("category", "keyword", "doc_count").orderBy(F.desc("doc_count"), "category", "keyword"))


# ---------------------------------------------------------------------------
# Ingest, merges, statistics.
# ---------------------------------------------------------------------------

def text_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text records (the landing schema) derived from documents."""
    return testdata.text_raw(spark, sf_dir).select(*TEXT_LANDING.fieldNames())


def image_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.images_raw(spark, sf_dir).select(*IMAGE_LANDING.fieldNames())


def with_nulls(landing: DataFrame, *required: str) -> DataFrame:
    """Every record, and beside it a copy without each of its required fields: those are not to be ingested."""
    out = landing
    for c in required:
        out = out.unionByName(landing.withColumn(c, F.lit(None).cast("string")))
    return out


def q_ingest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ingest_text(with_nulls(text_landing(spark, sf_dir), "id", "text", "source"), as_of=testdata.TEST_AS_OF)
    return out.select("id", "source", "title", "text", "timestamp", "ingestion_timestamp", "content_hash")


def q_ingest_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ingest_images(with_nulls(image_landing(spark, sf_dir), "id", "filepath", "source"), as_of=testdata.TEST_AS_OF)
    return out.select("id", "source", "filepath", "file_size", "timestamp", "ingestion_timestamp",
                      "image_hash")


def q_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target holds the English records; the landing holds every record twice (a replay)."""
    raw = testdata.text_raw(spark, sf_dir)
    target = raw.where(F.col("metadata")["lang"] == "en")
    replayed = raw.unionByName(raw)
    merged = merge_insert_only(target, replayed, "content_hash")
    return merged.select("id", "source", "content_hash")


def q_load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records loaded in parts that overlap, one of them twice, then all of them once more."""
    raw = testdata.text_raw(spark, sf_dir)
    path = scratch_path(spark, "raw_loads")
    lang = F.col("metadata")["lang"]
    for part in (raw.where(lang.isin("en", "fr")), raw.where(lang.isin("fr", "de")), raw.where(lang.isin("fr", "de")), raw):
        load_raw(part, path, "content_hash")
    return read_table(spark, path).select("id", "source", "content_hash")


def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: fallback-classified rows; source: re-enriched fr/de rows one day later, replayed."""
    raw = testdata.text_raw(spark, sf_dir)
    cols = ["id", "content_hash", "is_threat", "threat_severity", "enrichment_timestamp"]
    target = fallback_enrich(raw, "a", enrichment_ts=F.col("ingestion_timestamp")).select(cols)
    later = F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY")
    # The enrichment job writes its batch; the merge reads it (here: landed twice, a replay).
    batch = write_table(enrich_text(raw.where(F.col("metadata")["lang"].isin("fr", "de")),
                                    analysis_dictionary(), enrichment_ts=later).select(cols), "upsert_batch")
    return merge_upsert(target, batch.unionByName(batch), "content_hash",
                        [("enrichment_timestamp", False), ("id", True)])


def q_ingest_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ingest_stats_text(testdata.text_raw(spark, sf_dir))


def q_ingest_stats_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ingest_stats_images(testdata.images_raw(spark, sf_dir))


def q_records_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.records_by_source(testdata.text_raw(spark, sf_dir))


def q_stream_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.stream_stats_text(enriched_tables(spark, sf_dir)[0])


def q_stream_stats_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.stream_stats_images(enriched_tables(spark, sf_dir)[1])


def q_stats_category_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, images = enriched_tables(spark, sf_dir)
    return (stats.category_distribution(text).withColumn("content_type", F.lit("text"))
            .unionByName(stats.category_distribution(images).withColumn("content_type", F.lit("image"))))


def q_stats_severity_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, images = enriched_tables(spark, sf_dir)
    return (stats.severity_counts(text).withColumn("content_type", F.lit("text"))
            .unionByName(stats.severity_counts(images).withColumn("content_type", F.lit("image"))))


QUERIES.update({
    "fallback_classifier_a": q_fallback("a"),
    "fallback_classifier_b": q_fallback("b"),
    "harmonize_schema": q_harmonize_schema,
    "keyword_lookup_join": q_keyword_lookup_join,
    "ingest_text": q_ingest_text,
    "ingest_images": q_ingest_images,
    "merge_insert_only": q_merge_insert_only,
    "merge_upsert": q_merge_upsert,
    "load_raw": q_load_raw,
    "ingest_stats_text": q_ingest_stats_text,
    "ingest_stats_images": q_ingest_stats_images,
    "records_by_source": q_records_by_source,
    "stream_stats_text": q_stream_stats_text,
    "stream_stats_images": q_stream_stats_images,
    "stats_category_distribution": q_stats_category_distribution,
    "stats_severity_distribution": q_stats_severity_distribution,
})


# ---------------------------------------------------------------------------
# Collector payloads (derived from the driver tables), catalog, landing scans.
# ---------------------------------------------------------------------------

def _s(c: str) -> Column:
    return F.col(c).cast("string")


def wiki_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = testdata.table(spark, sf_dir, "documents")
    page = F.concat(F.lit("https://wiki.example.org/"), _s("doc_id"))
    return d.select(F.to_json(F.struct(
        F.col("doc_id").alias("pageid"), F.substring("text", 1, 60).alias("title"),
        F.col("text").alias("extract"), F.col("lang").alias("description"),
        F.struct(F.struct(page.alias("page")).alias("desktop")).alias("content_urls"))).alias("payload"))


def social_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = testdata.table(spark, sf_dir, "conversations")
    post = F.concat_ws("_", _s("conv_id"), _s("turn"))
    child = F.struct(
        post.alias("id"), F.substring("text", 1, 80).alias("title"),
        F.when(F.col("role") == "assistant", F.col("text")).otherwise(F.lit("")).alias("selftext"),
        F.concat(F.lit("/r/"), F.col("role"), F.lit("/comments/"), post).alias("permalink"),
        (F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60).cast("double").alias("created_utc"),
        F.col("role").alias("author"), F.col("turn").alias("score"),
        F.length("text").cast("bigint").alias("num_comments"),
        (F.col("turn") % 2 == 1).alias("is_video"))
    # a conversation's turns of one role are a listing's children, in order
    own = c.select("conv_id", F.col("role").alias("subreddit"), F.struct("turn", F.struct(child.alias("data")).alias("child")).alias("c"))
    children = F.transform(F.array_sort(F.collect_list("c")), lambda x: x["child"])
    return (own.groupBy("conv_id", "subreddit").agg(children.alias("children"))
            .select(F.to_json(F.struct(F.struct("children").alias("data"))).alias("payload"), "subreddit"))


def _xml_escape(col: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        col = F.replace(col, F.lit(a), F.lit(b))
    return col


def _xml_elem(tag: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), _xml_escape(value), F.lit(f"</{tag}>"))


def rss_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = testdata.table(spark, sf_dir, "conversations")
    body = F.trim(F.regexp_replace("text", r"[\t\n\r ]+", " "))
    link = F.concat(F.lit("https://"), F.col("role"), F.lit(".example.com/item/"),
                    _s("conv_id"), F.lit("/"), _s("turn"))
    pub = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60),
                        "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    item = F.concat_ws(
        "", F.lit("<item>"), _xml_elem("title", F.trim(F.substring(body, 1, 60))),
        _xml_elem("description", body), _xml_elem("link", link),
        F.when(F.col("turn") % 2 == 0, _xml_elem("pubDate", pub)),
        F.when(F.col("role") == "user", _xml_elem("author", _s("conv_id"))),
        F.lit("</item>"))
    # a conversation's turns of one role are a feed's items, in order
    own = c.select("conv_id", "role", F.struct("turn", item.alias("item")).alias("i"))
    items = F.array_join(F.transform(F.array_sort(F.collect_list("i")), lambda x: x["item"]), "")
    feed = F.concat(F.lit('<rss version="2.0"><channel><title>feed</title>'), items, F.lit("</channel></rss>"))
    return (own.groupBy("conv_id", "role").agg(feed.alias("payload"))
            .select("payload", F.concat(F.lit("https://"), F.col("role"), F.lit(".example.com/rss.xml")).alias("feed_url")))


def q_normalize_wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normalize_wiki(wiki_payloads(spark, sf_dir), collected_at=testdata.TEST_AS_OF)
    return out.select("id", "source", "title", "text", "url", "timestamp", "author",
                      F.col("metadata")["description"].alias("description"))


def q_normalize_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normalize_social(social_listings(spark, sf_dir))
    m = F.col("metadata")
    return out.select("id", "source", "title", "text", "url", "timestamp", "author",
                      m["score"].alias("score"), m["num_comments"].alias("num_comments"),
                      m["is_video"].alias("is_video"))


def q_normalize_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normalize_rss(rss_feeds(spark, sf_dir), collected_at=testdata.TEST_AS_OF)
    return out.select("id", "source", "title", "text", "url", "timestamp", "author",
                      F.col("metadata")["category"].alias("category"))


def q_first_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two items of each feed and listing."""
    news = normalize_rss(rss_feeds(spark, sf_dir), collected_at=testdata.TEST_AS_OF, max_items=2)
    return news.unionByName(normalize_social(social_listings(spark, sf_dir), max_items=2)).select("id", "source", "title")


def with_broken(payloads: DataFrame) -> DataFrame:
    """Every payload, and beside it a copy cut short, one that is an error message, and none."""
    broken = F.explode(F.array(F.col("payload"), F.expr("left(payload, length(payload) - 9)"), F.lit('{"error": 429}'), F.lit(None).cast("string")))
    return payloads.withColumn("payload", broken)


def q_broken_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by source, and rejected payloads by kind and reason, of collections with broken payloads in them."""
    wiki, feeds, listings = (with_broken(f(spark, sf_dir)) for f in (wiki_payloads, rss_feeds, social_listings))
    records = union_sources(normalize_wiki(wiki.where("payload NOT LIKE '{\"error%' OR payload IS NULL"), collected_at=testdata.TEST_AS_OF),
                            normalize_rss(feeds, collected_at=testdata.TEST_AS_OF), normalize_social(listings))
    rejected = union_sources(rejected_payloads(feeds, "rss"), rejected_payloads(listings, "social"),
                             rejected_payloads(wiki.where("payload NOT LIKE '{\"error%' OR payload IS NULL"), "wiki"))
    return (records.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(F.lit("record").alias("kind"), F.col("source").alias("name"), "n")
            .unionByName(rejected.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n")).select("kind", F.col("reason").alias("name"), "n")))


def collected_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_sources(
        normalize_wiki(wiki_payloads(spark, sf_dir), collected_at=testdata.TEST_AS_OF),
        normalize_rss(rss_feeds(spark, sf_dir), collected_at=testdata.TEST_AS_OF),
        normalize_social(social_listings(spark, sf_dir)))


def q_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collected_text(spark, sf_dir).select("id", "source", "title", "text")


def q_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected records of the last three days, by day and source, from a table that lies in the order of time."""
    pin_utc(spark)
    table = write_clustered(with_event_time(collected_text(spark, sf_dir)), scratch_path(spark, "events"), "event_time")
    return (recent(table, 3, testdata.TEST_AS_OF).groupBy(F.to_date("event_time").alias("event_date"), "source")
            .agg(F.count(F.lit(1)).alias("n"), F.min("event_time").alias("first_time")))


def q_collection_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection_stats_text(collected_text(spark, sf_dir))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bytes as a binaryFile-like frame (path, source, content)."""
    p = testdata.table(spark, sf_dir, "pages")
    return p.select(F.col("url").alias("path"), url_host(F.col("url")).alias("source"),
                    F.encode("html", "UTF-8").alias("content"), F.col("page_id"))


def q_image_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_catalog(page_files(spark, sf_dir))


def q_image_valid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = valid_content(page_files(spark, sf_dir), kinds=("jpeg", "png", "gif", "html"))
    return ok.select(F.concat(F.lit("page_"), _s("page_id")).alias("id"), "content_kind")


def _be(value: str, n: int) -> str:
    """``n`` bytes of a number, the highest first, as SQL."""
    return f"unhex(lpad(hex(cast({value} AS bigint)), {2 * n}, '0'))"


def _le16(value: str) -> str:
    return f"unhex(concat(lpad(hex({value} % 256), 2, '0'), lpad(hex({value} div 256), 2, '0')))"


def _png_chunk(name: str, data: str) -> str:
    body = f"concat(cast('{name}' AS binary), {data})"
    return f"concat({_be(f'octet_length({data})', 4)}, {body}, {_be(f'crc32({body})', 4)})"


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's bytes, and images made of them: a PNG, a JPEG and a GIF file with the page as their data,
    and each cut short by a byte. Width and height come from the page's number and length."""
    p = testdata.table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumns({"w": F.expr("cast(page_id % 60000 + 1 AS int)"), "h": F.expr("cast(length(html) % 60000 + 1 AS int)"),
                       "data": F.expr("cast(html AS binary)"), "some": F.expr("cast(left(html, 10000) AS binary)")})
    size, nothing = f"concat({_be('w', 4)}, {_be('h', 4)}, unhex('0802000000'))", "unhex('')"
    png = f"concat(unhex('89504E470D0A1A0A'), {_png_chunk('IHDR', size)}, {_png_chunk('IDAT', 'data')}, {_png_chunk('IEND', nothing)})"
    jpeg = (f"concat(unhex('FFD8FFFE'), {_be('octet_length(some) + 2', 2)}, some, unhex('FFC0001108'), {_be('h', 2)}, {_be('w', 2)}, "
            "unhex('03012200021101031101FFDA0008010100003F0012FF0034FFD056FFD9'))")
    gif = (f"concat(cast('GIF89a' AS binary), {_le16('w')}, {_le16('h')}, unhex('800000000000FFFFFF21F90400000000002C00000000'), "
           f"{_le16('w')}, {_le16('h')}, unhex('0002024C01003B'))")
    made = F.expr(f"explode(map('png', {png}, 'jpeg', {jpeg}, 'gif', {gif}, 'html', data))").alias("kind", "whole")
    cut = F.expr("explode(array(struct('whole' AS state, whole AS content), struct('cut' AS state, substring(whole, 1, length(whole) - 1) AS content)))")
    return (p.select("page_id", "url", made).withColumn("c", cut)
            .select("page_id", "url", "kind", "c.state", "c.content", F.concat_ws("/", "url", "kind", "c.state").alias("path")))


def q_image_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and size of the whole images among all pages' files."""
    return whole_images(page_images(spark, sf_dir)).select("page_id", "state", "header.kind", "header.width", "header.height")


def q_image_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing records of all pages' files, ingested as raw images."""
    family = F.element_at(F.lit(IMAGE_FAMILIES), (F.col("page_id") % len(IMAGE_FAMILIES) + 1).cast("int"))
    files = page_images(spark, sf_dir).withColumn("source", family)
    raw = ingest_images(image_records(files, category_col="kind", collected_at=testdata.TEST_AS_OF), as_of=testdata.TEST_AS_OF)
    return raw.select(F.regexp_extract("id", "^(.*)_[0-9a-f]{8}$", 1).alias("id_prefix"), "source", "url", "filepath", "dimensions", "category", "timestamp",
                      F.col("metadata")["license"].alias("license"), F.col("metadata")["search_term"].alias("search_term"))


def q_collection_stats_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = F.element_at(F.lit(IMAGE_FAMILIES), (F.col("page_id") % len(IMAGE_FAMILIES) + 1).cast("int"))
    return collection_stats_images(image_catalog(page_files(spark, sf_dir).withColumn("source", family)))


def q_scan_text_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land text records as JSON files (shared scratch folder), scan them back with the schema."""
    path = scratch_path(spark, "landing_text")
    text_landing(spark, sf_dir).write.mode("overwrite").json(path)
    return scan_text_json(spark, path).select("id", "source", "title", "text", "url", "timestamp", "author",
                                              F.col("metadata")["lang"].alias("lang"))


def q_scan_text_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land text records as the collectors do, an indented JSON array a file, and read them by many tasks."""
    path = scratch_path(spark, "landing_arrays")
    records = text_landing(spark, sf_dir).select(*TEXT_LANDING.fieldNames())
    land_json_arrays(spread_for_cpu(records, cores_beyond_splits(records)), path)
    return (scan_text_json(spark, path, multi_line=True).where("id IS NOT NULL")
            .select("id", "source", "title", "text", "url", "timestamp", "author", F.col("metadata")["lang"].alias("lang")))


def q_scan_image_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing_images")
    image_landing(spark, sf_dir).write.mode("overwrite").json(path)
    return scan_image_json(spark, path).select("id", "source", "filepath", "file_size", "timestamp")


QUERIES.update({
    "normalize_wiki": q_normalize_wiki,
    "normalize_social": q_normalize_social,
    "normalize_rss": q_normalize_rss,
    "first_items": q_first_items,
    "broken_payloads": q_broken_payloads,
    "union_sources": q_union_sources,
    "recent_events": q_recent_events,
    "collection_stats_text": q_collection_stats_text,
    "image_catalog": q_image_catalog,
    "image_valid_filter": q_image_valid_filter,
    "image_headers": q_image_headers,
    "image_landing": q_image_landing,
    "collection_stats_images": q_collection_stats_images,
    "scan_text_json": q_scan_text_json,
    "scan_text_arrays": q_scan_text_arrays,
    "scan_image_json": q_scan_image_json,
})


# ---------------------------------------------------------------------------
# Streaming: landing + replay of the same files, availableNow, latest-wins read.
# ---------------------------------------------------------------------------

def _run_stream(start, spark: SparkSession, raw: DataFrame, name: str, **kw) -> str:
    """Records are landed, then landed again (a replay); the stream takes in what has landed, the second time from
    its checkpoint. A batch holds all files of a landing: a file a batch would leave all cores but one idle, and
    each batch has its own cost (offsets, state, a folder of files by severity and source)."""
    source, target, checkpoint = (scratch_path(spark, f"{name}_{part}") for part in ("raw", "enriched", "checkpoint"))
    raw = spread_for_cpu(raw, cores_beyond_splits(raw))
    for _ in range(2):
        raw.write.mode("append").parquet(source)
        q = start(spark, source, target, analysis_dictionary(), checkpoint=checkpoint, trigger={"availableNow": True}, **kw)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return target


def q_stream_enrich_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    target = _run_stream(start_text_enrichment, spark, testdata.text_raw(spark, sf_dir), "stream_text")
    out = read_latest(spark, target, "content_hash")
    return out.select("id", "source", "content_hash", "is_threat", "threat_severity",
                      _joined("threat_categories").alias("threat_categories"))


def q_stream_enrich_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    target = _run_stream(start_image_enrichment, spark, testdata.images_raw(spark, sf_dir), "stream_images")
    out = read_latest(spark, target, "image_hash")
    return out.select("id", "source", "image_hash", "ocr_success", "text_length", "is_threat",
                      "threat_severity", _joined("threat_categories").alias("threat_categories"))


def q_stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream writes of records that are landed twice, all batch folders together: each once."""
    pin_utc(spark)
    target = _run_stream(start_text_enrichment, spark, testdata.text_raw(spark, sf_dir), "stream_seen", horizon="1 day")
    return read_table(spark, target).groupBy("id", "content_hash").agg(F.count(F.lit(1)).alias("rows_written"))


def q_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-batch metrics, summed: how files are dealt into batches doesn't change the sums."""
    pin_utc(spark)
    metrics = scratch_path(spark, "stream_metrics")
    _run_stream(start_image_enrichment, spark, testdata.images_raw(spark, sf_dir), "stream_metrics",
                metrics_path=metrics)
    return spark.read.parquet(metrics).agg(*[F.sum(c).alias(c) for c in ("records", "threats", "ocr_success")])


def q_compacted_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch, compaction, a rerun of the batch, compaction, a stream, another rerun: read behind the snapshot.

    The first run knows the published dictionary only; each later step enriches some languages anew, so the
    table is right only if every step's rows replace those before.
    """
    pin_utc(spark)
    raw = testdata.text_raw(spark, sf_dir)
    target, snapshot, landed = (scratch_path(spark, n) for n in ("upserts", "upserts_snapshot", "upserts_raw"))

    def batch(dictionary, days: int, *langs: str) -> None:
        rows = raw.where(F.col("metadata")["lang"].isin(*langs)) if langs else raw
        ts = F.col("ingestion_timestamp") + F.expr(f"INTERVAL {days} DAY")
        append_batch(enrich_text(rows, dictionary, enrichment_ts=ts).drop("combined_text"), target, "content_hash")

    batch(reference_dictionary(), 0)
    compact(spark, target, "content_hash", snapshot)
    batch(analysis_dictionary(), 1, "fr", "de")
    compact(spark, target, "content_hash", snapshot)
    raw.where(F.col("metadata")["lang"] == "es").write.mode("append").parquet(landed)
    q = start_text_enrichment(spark, landed, target, analysis_dictionary(), trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    batch(analysis_dictionary(), 2, "en")
    out = read_latest(spark, target, "content_hash", snapshot)
    return out.select("id", "source", "content_hash", "is_threat", "threat_severity", _joined("threat_categories").alias("threat_categories"))


def q_maintained_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by severity and threats by category, kept by deltas over batches that replace each other's rows."""
    pin_utc(spark)
    raw = testdata.text_raw(spark, sf_dir)
    target, statistics = scratch_path(spark, "kept_table"), scratch_path(spark, "kept_stats")
    steps = [(reference_dictionary(), ("en", "fr", "de", "es")), (analysis_dictionary(), ("fr", "de")), (analysis_dictionary(), ("en", "es"))]
    for day, (dictionary, langs) in enumerate(steps):
        ts = F.col("ingestion_timestamp") + F.expr(f"INTERVAL {day} DAY")
        rows = enrich_text(raw.where(F.col("metadata")["lang"].isin(*langs)), dictionary, enrichment_ts=ts).drop("combined_text")
        write_batch(rows, target, BATCH_JOB, day, "content_hash")
        write_deltas(spark, target, statistics, BATCH_JOB, day, "content_hash")
    kept = maintained(spark, statistics)
    return (severity_counts(kept).select(F.lit("severity").alias("kind"), F.col("threat_severity").alias("name"), "count")
            .unionByName(category_distribution(kept).select(F.lit("category").alias("kind"), F.col("category").alias("name"), "count"))
            .where("count > 0"))


QUERIES.update({
    "maintained_stats": q_maintained_stats,
    "compacted_upserts": q_compacted_upserts,
    "stream_enrich_text": q_stream_enrich_text,
    "stream_enrich_images": q_stream_enrich_images,
    "stream_first_seen": q_stream_first_seen,
    "batch_metrics": q_batch_metrics,
})
