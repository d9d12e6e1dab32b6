"""Scans of landed files: text and image-metadata JSON, the dictionary file.

Schemas are declared, never inferred: an inferred schema costs an extra pass
over all files and lets stray files (a statistics JSON in the landing folder)
add columns. Records missing required fields are dropped by the ingest filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.functions.dictionary import ThreatDictionary
from contentrisk.schemas import DICTIONARY_FILE, IMAGE_LANDING, TEXT_LANDING
from contentrisk.sources.json_arrays import scan_json_arrays


def scan_text_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed text records. ``multi_line=True`` for files holding one JSON array each, dealt over as many
    tasks as their size makes splits (``json_arrays``)."""
    return scan_json_arrays(spark, path, TEXT_LANDING) if multi_line else spark.read.schema(TEXT_LANDING).json(path)


def scan_image_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return scan_json_arrays(spark, path, IMAGE_LANDING) if multi_line else spark.read.schema(IMAGE_LANDING).json(path)


def scan_binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Landed binary items (images, pages): path, modificationTime, length, content."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", True).load(path)


def land_json(df: DataFrame, path: str) -> None:
    """Write records as JSON (one object per line, non-ASCII kept); order carries no meaning."""
    df.write.mode("append").json(path)


def land_json_arrays(df: DataFrame, path: str) -> None:
    """Write records as the collectors do, an indented JSON array a file. A file is what a task writes of its own
    partition, so no task holds more than that; an empty partition makes an empty file."""
    records = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's records: ``[`` in front of the first, a comma in front of the others, ``]`` behind."""
        begun = False
        for batch in batches:
            for rows in (batch.slice(0, 1), batch.slice(1)):
                if rows.num_rows:
                    before = "," if begun else "["
                    values = pc.binary_join_element_wise(pa.scalar(before), rows.column(0).cast(pa.string()), "")
                    yield pa.RecordBatch.from_arrays([values], ["value"])
                    begun = True
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])

    records.mapInArrow(bracketed, "value string").write.mode("append").text(path)


def load_dictionary(spark: SparkSession, path: str, as_of=None) -> DataFrame:
    """Dictionary file -> one row per category (patterns default to [])."""
    raw = spark.read.schema(DICTIONARY_FILE).option("multiLine", True).json(path)
    ts = F.current_timestamp() if as_of is None else F.to_timestamp(F.lit(as_of))
    return (raw.select(F.explode("threat_categories").alias("category", "d"), "metadata.version")
            .select("category", "d.description", "d.keywords",
                    F.coalesce("d.patterns", F.array().cast("array<string>")).alias("patterns"),
                    "d.severity_levels", ts.alias("ingestion_timestamp"), "version"))


def dictionary_frame(spark: SparkSession, dictionary: ThreatDictionary, as_of=None) -> DataFrame:
    """The same table built from an in-memory dictionary (one row per category)."""
    rows = [(c.name, c.description, list(c.keywords), list(c.patterns),
             {k: list(v) for k, v in c.severity_levels}, dictionary.version)
            for c in dictionary.categories]
    df = spark.createDataFrame(rows, "category string, description string, keywords array<string>, "
                                     "patterns array<string>, severity_levels map<string,array<string>>, "
                                     "version string")
    ts = F.current_timestamp() if as_of is None else F.to_timestamp(F.lit(as_of))
    return df.select("category", "description", "keywords", "patterns", "severity_levels",
                     ts.alias("ingestion_timestamp"), "version")


def collect_dictionary(dict_df: DataFrame, max_categories: int = 10_000) -> ThreatDictionary:
    """Driver copy of a dictionary table, to compile it into expressions.

    Bounded: one row per category; refuses tables above ``max_categories`` rows.
    """
    rows = dict_df.select("category", "description", "keywords", "patterns",
                          "severity_levels", "version").limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"dictionary has more than {max_categories} categories")
    return ThreatDictionary.from_rows(rows)


def keyword_lookup(dict_df: DataFrame) -> DataFrame:
    """Flattened (category, keyword) pairs, distinct."""
    return dict_df.select("category", F.explode("keywords").alias("keyword")).distinct()


def keywords_per_category(dict_df: DataFrame) -> DataFrame:
    return dict_df.select("category", F.size("keywords").alias("keyword_count"))
