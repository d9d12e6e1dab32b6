"""Column expressions for hashing, text extraction and URL parsing.

All are built-in Spark functions (JVM, codegen); each has a one-to-one DuckDB
spelling in ``plans.oracle`` so the same rule can be checked independently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The regular expressions of the HTML-to-text rule (script and
# style blocks removed, tags to a space, whitespace collapsed, trimmed) and the
# URL host rule. They are shared verbatim with the DuckDB oracle.
SCRIPT_STYLE_RE = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
TAG_RE = r"<[^>]*>"
WHITESPACE_RE = r"[\t\n\x0B\f\r ]+"
URL_HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)"
# Entities decoded after tag removal ('&amp;' last).
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&nbsp;", " "), ("&amp;", "&")]


def content_hash(id_col: Column, text_col: Column, source_col: Column) -> Column:
    """md5 over id, text, source joined by '||' (nulls skipped, as concat_ws does)."""
    return F.md5(F.concat_ws("||", id_col, text_col, source_col))


def image_hash(id_col: Column, filepath_col: Column) -> Column:
    """md5 over id and filepath: a hash of the metadata, not of the bytes."""
    return F.md5(F.concat_ws("||", id_col, filepath_col))


def collapse_whitespace(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, WHITESPACE_RE, " "))


def html_to_text(col: Column) -> Column:
    s = F.regexp_replace(col, SCRIPT_STYLE_RE, " ")
    s = F.regexp_replace(s, TAG_RE, " ")
    for ent, ch in HTML_ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return collapse_whitespace(s)


def url_host(col: Column) -> Column:
    return F.regexp_extract(col, URL_HOST_RE, 1)
