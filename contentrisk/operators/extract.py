"""Text extraction from landed content (the reference's OCR step, re-aimed).

The content bytes travel in the DataFrame (``binaryFile`` or a string column),
so extraction runs on whichever executor holds the row; nothing is read from a
machine-local path. Built in: HTML-to-text as native expressions. Pluggable:
any ``bytes|str -> str`` callable, run Arrow-batched through a pandas UDF with
per-row error capture (an unreadable item yields '' rather than failing the job).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from contentrisk.functions.text import collapse_whitespace, html_to_text

Extractor = Callable[[object], str]


def _as_string(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.try_validate_utf8(col.cast("string"))   # null, so '', where the bytes are no UTF-8
    return col


def pluggable_extractor(fn: Extractor) -> Callable[[Column], Column]:
    """Wrap a per-item extractor as an Arrow-batched column function."""

    def safe(x):
        if x is None:
            return ""
        try:
            out = fn(x)
            return out if isinstance(out, str) else ""
        except Exception:  # unreadable item: empty text, like a failed OCR
            return ""

    @pandas_udf(T.StringType())
    def _extract(s: pd.Series) -> pd.Series:
        return s.map(safe)

    return lambda c: collapse_whitespace(_extract(c))


def extract_text(df: DataFrame, content_col: str = "content",
                 extractor: str | Extractor = "html",
                 out_col: str = "extracted_text") -> DataFrame:
    dtype = df.schema[content_col].dataType
    if extractor == "html":
        expr = html_to_text(_as_string(F.col(content_col), dtype))
    elif callable(extractor):
        expr = pluggable_extractor(extractor)(F.col(content_col))
    else:
        raise ValueError(f"unknown extractor {extractor!r}")
    return df.withColumn(out_col, F.coalesce(expr, F.lit("")))


def same_path(col: Column) -> Column:
    """Compare paths without the ``file:`` scheme and duplicate leading slashes."""
    return F.regexp_replace(F.regexp_replace(col, r"^file:", ""), r"^/+", "/")


def attach_content(meta: DataFrame, files: DataFrame, path_col: str = "filepath",
                   content_col: str = "content") -> DataFrame:
    """Bring the landed bytes to each metadata row: an equi-join on the normalised path.

    ``files`` is a ``binaryFile`` scan (path, content, ...). Metadata rows without
    a landed file keep a null content (extraction gives ''). Both sides are large,
    so this is a plain shuffle join on the path, which AQE may turn into a broadcast
    when the file listing is small.
    """
    right = files.select(same_path(F.col("path")).alias("__path"), F.col("content").alias(content_col))
    left = meta.withColumn("__path", same_path(F.col(path_col)))
    return left.join(right, on="__path", how="left").drop("__path")
