"""The analytics queries over the enriched tables, as DataFrame plans.

Every query takes the two enriched tables (text, images) and, where it has a
recency filter, an ``as_of`` date; nothing reads the wall clock unless asked.
Rates use SQL decimal arithmetic (``n * 100.0 / d``) and are returned as
double. Dates are UTC days of ``enrichment_timestamp``.

Scale notes: every query is a scan -> filter -> (explode) -> partial hash
aggregate -> shuffle of small per-partition partials. Windows and sorts only
ever see aggregated rows (days x sources x categories), never raw rows; the
"latest per category" query's window is cut to one narrow row per category and task
before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def _date(col: str = "enrichment_timestamp"):
    return F.to_date(F.col(col)).alias("event_date")


def _pct(num: str, den: str, scale: int = 2):
    return F.expr(f"round({num} * 100.0 / {den}, {scale})").cast("double")


def _threat_flag_counts():
    return [
        F.sum(F.when(F.col("is_threat") == F.lit(True), 1).otherwise(0)).cast("bigint").alias("threat_count"),
        F.sum(F.when(F.col("is_threat") == F.lit(False), 1).otherwise(0)).cast("bigint").alias("benign_count"),
        F.count(F.lit(1)).alias("total_count"),
    ]


def _daily_counts(text: DataFrame, images: DataFrame) -> DataFrame:
    # Per-branch aggregates, UNION ALL: a source present in both gives two rows.
    t = text.groupBy(_date(), "source").agg(*_threat_flag_counts())
    i = images.groupBy(_date(), "source").agg(*_threat_flag_counts())
    return t.unionByName(i)


def daily_threat_ratio(text: DataFrame, images: DataFrame) -> DataFrame:
    return (_daily_counts(text, images)
            .select("event_date", "source", "threat_count", "benign_count", "total_count",
                    _pct("threat_count", "total_count").alias("threat_percentage"),
                    _pct("benign_count", "total_count").alias("benign_percentage"),
                    F.expr("round(threat_count * 1.0 / nullif(benign_count, 0), 4)").cast("double")
                    .alias("threat_to_benign_ratio"))
            .orderBy(F.desc("event_date"), "source"))


def daily_threat_ratio_brief(text: DataFrame, images: DataFrame) -> DataFrame:
    return daily_threat_ratio(text, images).drop("benign_percentage")


def _exploded_threats(df: DataFrame, content_type: str, *cols: str) -> DataFrame:
    return (df.where(F.col("is_threat") == F.lit(True))
            .select(*cols, F.explode("threat_categories").alias("threat_category"))
            .withColumn("content_type", F.lit(content_type)))


def daily_threat_categories(text: DataFrame, images: DataFrame) -> DataFrame:
    cols = ("enrichment_timestamp", "source")
    both = _exploded_threats(text, "text", *cols).unionByName(_exploded_threats(images, "image", *cols))
    return (both.groupBy(_date(), "source", "threat_category", "content_type")
            .agg(F.count(F.lit(1)).alias("threat_count"))
            .orderBy(F.desc("event_date"), F.desc("threat_count"), "source", "threat_category"))


def _latest_per_category(df: DataFrame, as_of: str | None, payload: list) -> DataFrame:
    """Top-1 per category by (enrichment_timestamp desc, id asc).

    ``row_number = 1`` over narrow columns: each task keeps one row a category before the shuffle
    (WindowGroupLimit), whatever the ties, so a hot category never lands on one task. The winners, one row
    a category of the dictionary, are broadcast to fetch their payload.
    """
    since = F.date_sub(F.current_date() if as_of is None else F.to_date(F.lit(as_of)), 7)
    recent = df.where((F.col("is_threat") == F.lit(True)) & (F.col("enrichment_timestamp") >= since))
    exploded = recent.select("id", "enrichment_timestamp", F.explode("threat_categories").alias("threat_category"))
    first = F.row_number().over(Window.partitionBy("threat_category").orderBy(F.desc("enrichment_timestamp"), "id"))
    won = exploded.withColumn("rn", first).where("rn = 1").select("threat_category", F.col("id").alias("won_id"), F.col("enrichment_timestamp").alias("won_at"))
    best = (recent.join(F.broadcast(won), F.col("id").eqNullSafe(F.col("won_id")) & (F.col("enrichment_timestamp") == F.col("won_at")))
            .groupBy("threat_category").agg(F.first(F.struct(*payload)).alias("best")))   # of equal rows any
    return best.select("threat_category", "best.*")


def latest_threats(text: DataFrame, images: DataFrame, as_of: str | None = None) -> DataFrame:
    common = ["id", "source", "threat_severity", "enrichment_timestamp"]
    t = _latest_per_category(text, as_of, [F.col(c) for c in common] + [
        F.concat(F.substring(F.coalesce("title", "text"), 1, 100), F.lit("...")).alias("preview")])
    i = _latest_per_category(images, as_of, [F.col(c) for c in common] + [
        F.concat(F.lit("Image: "),
                 F.substring(F.coalesce(F.col("extracted_text"), F.lit("No text extracted")), 1, 80),
                 F.lit("...")).alias("preview"),
        F.col("filepath").alias("image_path")])
    t = t.withColumn("content_type", F.lit("text")).withColumn("image_path", F.lit(None).cast("string"))
    i = i.withColumn("content_type", F.lit("image"))
    cols = ["threat_category", "id", "source", "content_type", "threat_severity",
            "enrichment_timestamp", "preview", "image_path"]
    return (t.select(cols).unionByName(i.select(cols))
            .orderBy("threat_category", F.desc("enrichment_timestamp"), "content_type"))


def latest_threats_brief(text: DataFrame, images: DataFrame, as_of: str | None = None) -> DataFrame:
    common = ["id", "source", "threat_severity", "enrichment_timestamp"]
    t = _latest_per_category(text, as_of, [F.col(c) for c in common] + [
        F.substring("title", 1, 80).alias("preview")])
    i = _latest_per_category(images, as_of, [F.col(c) for c in common] + [
        F.substring("filepath", 1, 80).alias("preview")])
    t = t.withColumn("content_type", F.lit("text"))
    i = i.withColumn("content_type", F.lit("image"))
    cols = ["threat_category", "id", "source", "content_type", "threat_severity",
            "enrichment_timestamp", "preview"]
    return t.select(cols).unionByName(i.select(cols)).orderBy("threat_category", "content_type")


def severity_over_time(text: DataFrame, images: DataFrame) -> DataFrame:
    both = (text.select("enrichment_timestamp", "threat_severity")
            .unionByName(images.select("enrichment_timestamp", "threat_severity")))
    counts = both.groupBy(_date(), "threat_severity").agg(F.count(F.lit(1)).alias("count"))
    # Window over the aggregate (days x levels), not over raw rows.
    day_total = F.sum("count").over(Window.partitionBy("event_date"))
    return (counts.withColumn("__day_total", day_total)
            .select("event_date", "threat_severity", "count",
                    _pct("count", "__day_total").alias("percentage"))
            .orderBy(F.desc("event_date"), "threat_severity"))


def severity_distribution(text: DataFrame, images: DataFrame) -> DataFrame:
    both = (text.where(F.col("is_threat") == F.lit(True)).select("threat_severity")
            .unionByName(images.where(F.col("is_threat") == F.lit(True)).select("threat_severity")))
    counts = both.groupBy("threat_severity").agg(F.count(F.lit(1)).alias("count"))
    # Unpartitioned window: its input is at most one row per severity level.
    total = F.sum("count").over(Window.partitionBy())
    return (counts.withColumn("__total", total)
            .select("threat_severity", "count", _pct("count", "__total").alias("percentage"))
            .orderBy(F.desc("count"), "threat_severity"))


def top_sources(text: DataFrame, images: DataFrame) -> DataFrame:
    both = (_exploded_threats(text, "text", "source").drop("content_type")
            .unionByName(_exploded_threats(images, "image", "source").drop("content_type")))
    counts = (both.groupBy("source", "threat_category").agg(F.count(F.lit(1)).alias("threat_count"))
              .where(F.col("threat_count") > 0))
    # The rank is one more than the number of sources with a larger count, and depends on the count alone. The
    # window orders the distinct counts of a category: of n rows, at most sqrt(2n), however many sources.
    by_count = counts.groupBy("threat_category", "threat_count").agg(F.count(F.lit(1)).alias("sources"))
    larger = Window.partitionBy("threat_category").orderBy(F.desc("threat_count")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_count.select("threat_category", "threat_count", (F.coalesce(F.sum("sources").over(larger), F.lit(0)) + 1).alias("source_rank"))
    return (counts.join(ranks, ["threat_category", "threat_count"])
            .select("threat_category", "source", "threat_count", "source_rank")
            .orderBy("threat_category", F.desc("threat_count"), "source"))


def _ocr_counts():
    ok = F.sum(F.when(F.col("ocr_success") == F.lit(True), 1).otherwise(0)).cast("bigint")
    return [F.count(F.lit(1)).alias("total_images"), ok.alias("ocr_success_count")]


def ocr_success_daily(images: DataFrame) -> DataFrame:
    return (images.groupBy(_date(), "source")
            .agg(*_ocr_counts(), F.avg("text_length").alias("avg_extracted_text_length"))
            .select("event_date", "source", "total_images", "ocr_success_count",
                    _pct("ocr_success_count", "total_images").alias("ocr_success_rate"),
                    "avg_extracted_text_length")
            .orderBy(F.desc("event_date"), "source"))


def ocr_success_by_source(images: DataFrame) -> DataFrame:
    return (images.groupBy("source").agg(*_ocr_counts())
            .select("source", "total_images", "ocr_success_count",
                    _pct("ocr_success_count", "total_images").alias("ocr_success_rate"))
            .orderBy(F.desc("total_images"), "source"))


ANALYTICS = {
    "daily_threat_ratio": daily_threat_ratio,
    "daily_threat_ratio_brief": daily_threat_ratio_brief,
    "daily_threat_categories": daily_threat_categories,
    "latest_threats": latest_threats,
    "latest_threats_brief": latest_threats_brief,
    "severity_over_time": severity_over_time,
    "severity_distribution": severity_distribution,
    "top_sources": top_sources,
    "ocr_success_daily": lambda text, images: ocr_success_daily(images),
    "ocr_success_by_source": lambda text, images: ocr_success_by_source(images),
}
