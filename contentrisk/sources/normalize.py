"""Normalisers for landed collector payloads, and the binary content catalog.

The reference fetches article summaries, RSS feeds, social listings and
image bytes over HTTP and reshapes them in driver-side Python. Here the
payloads are assumed landed (one per row, as text or bytes) and each
reshaping is a Spark expression over them (``from_json``, ``from_xml``,
``posexplode``, ``md5``), so it runs distributed and in codegen.

Every normaliser returns the text landing schema (``schemas.TEXT_LANDING``),
so their outputs union by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentrisk.functions.text import url_host
from contentrisk.operators.enrich import TsSpec, ts_column
from contentrisk.schemas import IMAGE_LANDING, TEXT_LANDING
from contentrisk.sources.image_headers import whole_images

ISO = "yyyy-MM-dd'T'HH:mm:ss"

# Constants the collectors put into every record.
WIKI_SOURCE = "wikipedia"
WIKI_AUTHOR = "Wikipedia Contributors"
WIKI_META = {"type": "encyclopedia", "language": "en"}
NEWS_META = {"type": "news", "language": "en"}
NEWS_DEFAULT_CATEGORY = "general"
SOCIAL_META = {"type": "social_media", "platform": "reddit"}
SOCIAL_URL_PREFIX = "https://reddit.com"
UNKNOWN_AUTHOR = "Unknown"

#: Where the parsers put a payload that they can't read.
CORRUPT = "_corrupt_record"
WIKI_SCHEMA = ("pageid bigint, title string, extract string, description string, "
               "content_urls struct<desktop: struct<page: string>>")
RSS_SCHEMA = ("channel struct<item: array<struct<title: string, description: string, link: string, "
              "pubDate: string, author: string, category: string>>>")
LISTING_SCHEMA = ("data struct<children: array<struct<data: struct<id: string, title: string, "
                  "selftext: string, permalink: string, created_utc: double, author: string, "
                  "score: bigint, num_comments: bigint, is_video: boolean>>>>")


#: By kind of payload: its schema, its parser, and the part that lists its items.
PAYLOADS = {
    "wiki": (WIKI_SCHEMA, F.from_json, None),
    "rss": (RSS_SCHEMA, F.from_xml, "channel"),
    "social": (LISTING_SCHEMA, F.from_json, "data.children"),
}


def parsed_payloads(payloads: DataFrame, kind: str, payload_col: str = "payload") -> DataFrame:
    """``payloads`` with ``_parsed`` and ``_reason``: null, or why the payload gives no records ('no payload',
    'unreadable', or 'no items' where the part that lists them is missing, as in an error message)."""
    payload, options = F.col(payload_col), {"columnNameOfCorruptRecord": CORRUPT}
    schema, parse, items = PAYLOADS[kind]
    parsed = parse(payload, f"{schema}, {CORRUPT} string", options)
    missing = F.col(f"_parsed.{items}").isNull() if items else F.lit(False)
    return payloads.withColumn("_parsed", parsed).withColumn("_reason", (
        F.when(payload.isNull() | (F.trim(payload) == ""), "no payload")
        .when(F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull(), "unreadable")
        .when(missing, "no items")))


def readable(payloads: DataFrame, kind: str, payload_col: str) -> DataFrame:
    return parsed_payloads(payloads, kind, payload_col).where("_reason IS NULL")


def rejected_payloads(payloads: DataFrame, kind: str, payload_col: str = "payload") -> DataFrame:
    """The side table of what a normaliser leaves out: the input's columns, ``kind`` and ``reason``."""
    return (parsed_payloads(payloads, kind, payload_col).where("_reason IS NOT NULL")
            .select(*payloads.columns, F.lit(kind).alias("kind"), F.col("_reason").alias("reason")))


def _meta(const: dict, **cols: Column) -> Column:
    kv = []
    for k, v in const.items():
        kv += [F.lit(k), F.lit(v)]
    for k, c in cols.items():
        kv += [F.lit(k), c.cast("string")]
    return F.create_map(*kv)


def _landing(**cols: Column) -> list[Column]:
    return [cols.get(f, F.lit(None)).cast(TEXT_LANDING[f].dataType).alias(f)
            for f in TEXT_LANDING.fieldNames()]


def normalize_wiki(payloads: DataFrame, payload_col: str = "payload",
                   collected_at: TsSpec = None) -> DataFrame:
    """Article-summary JSON -> text record; missing fields become ''. Unreadable payloads give no record
    (``rejected_payloads`` has them)."""
    df = readable(payloads, "wiki", payload_col).select(F.col("_parsed").alias("a"), ts_column(collected_at).alias("_ts"))
    return df.select(*_landing(
        id=F.concat(F.lit("wiki_"), F.coalesce(F.col("a.pageid").cast("string"), F.lit(""))),
        source=F.lit(WIKI_SOURCE),
        title=F.coalesce("a.title", F.lit("")),
        text=F.coalesce("a.extract", F.lit("")),
        url=F.coalesce("a.content_urls.desktop.page", F.lit("")),
        timestamp=F.date_format("_ts", ISO),
        author=F.lit(WIKI_AUTHOR),
        metadata=_meta(WIKI_META, description=F.coalesce("a.description", F.lit(""))),
    ))


def normalize_rss(feeds: DataFrame, payload_col: str = "payload", feed_url_col: str = "feed_url",
                  collected_at: TsSpec = None, max_items: int | None = None) -> DataFrame:
    """RSS document -> one record per <item> (optionally the first ``max_items`` of each feed).

    Ids are ``news_`` + md5(link): stable across runs, so re-landing a feed is idempotent.
    """
    items = readable(feeds, "rss", payload_col).select(F.col(feed_url_col).alias("_feed"), ts_column(collected_at).alias("_ts"),
                                                       F.posexplode("_parsed.channel.item").alias("_pos", "i"))
    if max_items is not None:
        items = items.where(F.col("_pos") < max_items)
    link = F.coalesce("i.link", F.lit(""))
    return items.select(*_landing(
        id=F.concat(F.lit("news_"), F.md5(link)),
        source=url_host(F.col("_feed")),
        title=F.coalesce("i.title", F.lit("")),
        text=F.coalesce("i.description", F.lit("")),
        url=link,
        timestamp=F.coalesce("i.pubDate", F.date_format("_ts", ISO)),
        author=F.coalesce("i.author", F.lit(UNKNOWN_AUTHOR)),
        metadata=_meta(NEWS_META, category=F.coalesce("i.category", F.lit(NEWS_DEFAULT_CATEGORY))),
    ))


def normalize_social(listings: DataFrame, payload_col: str = "payload",
                     subreddit_col: str = "subreddit", max_items: int | None = None) -> DataFrame:
    """Listing JSON -> one record per child post; empty self-text falls back to the title."""
    posts = readable(listings, "social", payload_col).select(F.col(subreddit_col).alias("_sub"),
                                                             F.posexplode("_parsed.data.children").alias("_pos", "c"))
    if max_items is not None:
        posts = posts.where(F.col("_pos") < max_items)
    d = "c.data."
    return posts.select(*_landing(
        id=F.concat(F.lit("reddit_"), F.col(d + "id")),
        source=F.concat(F.lit("reddit_r_"), F.col("_sub")),
        title=F.coalesce(F.col(d + "title"), F.lit("")),
        text=F.coalesce(F.nullif(F.col(d + "selftext"), F.lit("")), F.col(d + "title"), F.lit("")),
        url=F.concat(F.lit(SOCIAL_URL_PREFIX), F.coalesce(F.col(d + "permalink"), F.lit(""))),
        timestamp=F.date_format(F.timestamp_seconds(F.coalesce(F.col(d + "created_utc"), F.lit(0.0))), ISO),
        author=F.coalesce(F.col(d + "author"), F.lit(UNKNOWN_AUTHOR)),
        metadata=_meta(SOCIAL_META, subreddit=F.col("_sub"),
                       score=F.coalesce(F.col(d + "score"), F.lit(0)),
                       num_comments=F.coalesce(F.col(d + "num_comments"), F.lit(0)),
                       is_video=F.coalesce(F.col(d + "is_video"), F.lit(False))),
    ))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Concatenate normalised collections (missing columns become null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------------------
# Binary content: catalog and validity filter.
# ---------------------------------------------------------------------------

# Leading bytes (hex) that identify a decodable item.
CONTENT_SIGNATURES = {
    "jpeg": "FFD8FF",
    "png": "89504E470D0A1A0A",
    "gif": "47494638",
}
# Fixed value: HTML documents are recognised by their (case-insensitive) opening.
HTML_OPENINGS = ["<!doctype html", "<html"]
# White space, an XML prologue and comments of any length may stand before it.
HTML_START = r"(?is)^(?:\uFEFF|\s|<\?xml[^>]*>|<!--.*?-->)*+(?:" + "|".join(HTML_OPENINGS) + ")"


def content_kind(content: Column) -> Column:
    """'jpeg' | 'png' | 'gif' | 'html' | null from the leading bytes of binary content."""
    expr = None
    for kind, sig in CONTENT_SIGNATURES.items():
        n = len(sig) // 2
        cond = F.hex(F.substring(content, 1, n)) == F.lit(sig)
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    text = F.try_validate_utf8(content.cast("string"))   # null where the bytes are no UTF-8
    return expr.when(text.rlike(HTML_START), F.lit("html"))


def valid_content(df: DataFrame, content_col: str = "content",
                  kinds: tuple[str, ...] = ("jpeg", "png", "gif")) -> DataFrame:
    """Drop items whose bytes are not a recognised format (undecodable -> no record)."""
    return (df.withColumn("content_kind", content_kind(F.col(content_col)))
            .where(F.col("content_kind").isin(*kinds)))


def image_catalog(files: DataFrame, source_col: str = "source", category_col: str | None = None,
                  content_col: str = "content", path_col: str = "path") -> DataFrame:
    """Per landed item: full content md5, id ``{source}[_{category}]_{md5[:8]}``, byte size."""
    h = F.md5(F.col(content_col))
    prefix = F.col(source_col) if category_col is None else F.concat_ws("_", source_col, category_col)
    return files.select(
        F.concat(prefix, F.lit("_"), F.substring(h, 1, 8)).alias("id"),
        F.col(source_col).alias("source"),
        F.col(path_col).alias("filepath"),
        F.length(F.col(content_col)).cast("bigint").alias("file_size"),
        h.alias("content_md5"),
    )


# What the collectors note of an image's source; the last for any other.
IMAGE_META = {
    "unsplash": {"platform": "unsplash", "license": "Unsplash License", "attribution_required": "true"},
    "picsum": {"platform": "Lorem Picsum", "image_type": "placeholder", "license": "Creative Commons CC0", "attribution_required": "false"},
    None: {"image_type": "placeholder", "license": "Free to use", "attribution_required": "false"},
}


def image_landing(files: DataFrame, source_col: str = "source", url_col: str = "url", category_col: str | None = None,
                  content_col: str = "content", path_col: str = "path", collected_at: TsSpec = None) -> DataFrame:
    """Landed images -> the landing records that ``ingest_images`` takes: one for each whole image, with its
    size from its own header. Cut files and other bytes give none."""
    source = F.col(source_col)
    category = F.lit(None).cast("string") if category_col is None else F.col(category_col)
    meta = F.map_concat(F.create_map(F.lit("platform"), source), _meta(IMAGE_META[None]))
    for name, own in IMAGE_META.items():
        if name:
            meta = F.when(source == name, _meta(own) if category_col is None else _meta(own, search_term=category)).otherwise(meta)
    h = F.md5(content_col)
    cols = {"id": F.concat_ws("_", source, category, F.substring(h, 1, 8)), "source": source, "url": F.col(url_col), "filepath": F.col(path_col),
            "file_size": F.octet_length(content_col), "timestamp": F.date_format(ts_column(collected_at), ISO), "metadata": meta,
            "dimensions": F.concat_ws("x", "header.width", "header.height"), "category": category}
    return whole_images(files, content_col).select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in IMAGE_LANDING.fields])


def collection_stats_text(records: DataFrame) -> DataFrame:
    """Records per source family: wikipedia by source, news / reddit by id."""
    return records.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col("source") == WIKI_SOURCE).alias("wikipedia"),
        F.count_if(F.col("id").contains("news")).alias("news"),
        F.count_if(F.col("id").contains("reddit")).alias("reddit"),
    )


# Image source families of the collection statistics.
IMAGE_FAMILIES = ["unsplash", "picsum", "placeholder", "placeimg"]


def collection_stats_images(catalog: DataFrame) -> DataFrame:
    """Items per source family (every family counted) and total size in MB."""
    return catalog.agg(
        F.count(F.lit(1)).alias("total_images"),
        *[F.count_if(F.col("source") == fam).alias(fam) for fam in IMAGE_FAMILIES],
        (F.coalesce(F.sum("file_size"), F.lit(0)) / F.lit(1024 * 1024)).cast("double").alias("total_size_mb"),
    )


def parse_event_ts(col: Column) -> Column:
    """Timestamp from the mixed landing formats: ISO-8601 or RFC-822 (weekday optional).

    The raw string is kept as landed; this gives the UTC instant next to it.
    """
    iso = F.try_to_timestamp(col)
    rfc = F.regexp_replace(col, r"^\s*[A-Za-z]{3},\s*", "")
    return F.coalesce(iso,
                      F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss z")),
                      F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z")))


def with_event_time(records: DataFrame, out_col: str = "event_time") -> DataFrame:
    """Landing records with the instant of their ``timestamp`` (null where it is in no known format); the string
    stays as landed. Write them with ``tables.write_clustered(..., by=out_col)`` for scans of recent records."""
    return records.withColumn(out_col, parse_event_ts(F.col("timestamp")))


def recent(records: DataFrame, days: int, as_of: str | None = None, col: str = "event_time") -> DataFrame:
    """The records of the last ``days`` days before ``as_of`` (today), by a filter that reaches the scan."""
    day = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    return records.where(F.col(col) >= F.date_sub(day, days).cast("timestamp"))
