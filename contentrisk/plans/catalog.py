"""Catalog registration, run-all and result export (the analytics runner's surface)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from contentrisk.plans import analytics


def register_views(spark: SparkSession, text_enriched: DataFrame, images_enriched: DataFrame) -> None:
    """Expose the enriched tables to SQL under the names the analytics SQL uses."""
    text_enriched.createOrReplaceTempView("text_enriched")
    images_enriched.createOrReplaceTempView("images_enriched")


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING PARQUET LOCATION (an external table over a folder)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING PARQUET LOCATION '{path}'")


def run_all(text_enriched: DataFrame, images_enriched: DataFrame,
            as_of: str | None = None) -> dict[str, DataFrame]:
    """Every analytics query as a DataFrame (lazy); ``as_of`` for the recency queries."""
    out = {}
    for name, fn in analytics.ANALYTICS.items():
        if name.startswith("latest_threats") and as_of is not None:
            out[name] = getattr(analytics, name)(text_enriched, images_enriched, as_of)
        else:
            out[name] = fn(text_enriched, images_enriched)
    return out


def save_results(results: dict[str, DataFrame], output_dir: str, stamp: str | None = None) -> dict[str, str]:
    """One CSV folder with header per query, overwritten, with a run stamp in its name.

    Results are aggregates (small), so each is written as a single file.
    """
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    paths = {}
    for name, df in results.items():
        path = f"{output_dir.rstrip('/')}/{name}_{stamp}.csv"
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        paths[name] = path
    return paths
