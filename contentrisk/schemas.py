"""Declared schemas (applied on read; never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

TEXT_LANDING = T.StructType([
    T.StructField("id", S), T.StructField("source", S), T.StructField("title", S),
    T.StructField("text", S), T.StructField("url", S), T.StructField("timestamp", S),
    T.StructField("author", S), T.StructField("metadata", T.MapType(S, S)),
])

IMAGE_LANDING = T.StructType([
    T.StructField("id", S), T.StructField("source", S), T.StructField("url", S),
    T.StructField("filepath", S), T.StructField("file_size", T.LongType()),
    T.StructField("timestamp", S), T.StructField("metadata", T.MapType(S, S)),
    T.StructField("dimensions", S), T.StructField("category", S),
])

TEXT_RAW = T.StructType(TEXT_LANDING.fields + [
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("content_hash", S),
])

IMAGE_RAW = T.StructType(IMAGE_LANDING.fields + [
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("image_hash", S),
])

DICTIONARY_FILE = T.StructType([
    T.StructField("threat_categories", T.MapType(S, T.StructType([
        T.StructField("description", S),
        T.StructField("keywords", T.ArrayType(S)),
        T.StructField("patterns", T.ArrayType(S)),
        T.StructField("severity_levels", T.MapType(S, T.ArrayType(S))),
    ]))),
    T.StructField("metadata", T.StructType([
        T.StructField("version", S), T.StructField("last_updated", S),
        T.StructField("author", S), T.StructField("description", S),
    ])),
])
