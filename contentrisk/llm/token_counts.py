"""Token counts by section: each document is encoded once, whole, and its tokens are joined to the
sections they lie in by their byte offsets.

The sections of a text are its lines (a line's end belongs to it), or, with several fields, the
fields in order, joined by line ends that belong to the field before. Token and section intervals
are both sorted, so the interval join is a search of each token's ends among the section bounds.
A token across a bound goes to the section that holds most of its bytes, the earlier of equals; so
sections add up to the document's tokens exactly. (Encoding sections one by one would not: it
forbids such tokens.)

Null and empty texts and fields have no bytes: a document without bytes has no tokens, and one empty
section. Repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.llm.common import clear_names, map_texts, raw
from contentrisk.llm.tokens import Tokenizer, load_ranks

RESULT = [T.StructField("n_tokens", T.LongType()), T.StructField("n_sections", T.LongType()), T.StructField("n_crossing", T.LongType()),
          T.StructField("section_tokens", T.ArrayType(T.LongType()))]


def attribute(begin: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's section, and the tokens that lie across a bound. ``bounds``: the sections' ends
    (the last is the end of all); intervals are in bytes and run on over documents."""
    section, last = np.searchsorted(bounds, begin, "right"), np.searchsorted(bounds, end - 1, "right")
    across = np.flatnonzero(section != last)
    for i in across.tolist():
        cuts = np.concatenate([[begin[i]], bounds[section[i]:last[i]], [end[i]]])
        section[i] += int(np.argmax(np.diff(cuts)))
    return section, across


def counter(ranks: bytes):
    tok = Tokenizer(ranks)

    def fn(texts: pa.Array) -> list[pa.Array]:
        ids, starts = tok.encode(texts)
        n = len(texts)
        data, bounds = raw(texts)
        doc_end = bounds[1:]
        lines = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
        # a text's last line ends with it; an empty text is a section without bytes
        inner = lines[~np.isin(lines, doc_end)]
        bounds = np.concatenate([inner, doc_end])
        owner = np.concatenate([np.searchsorted(doc_end, inner, "right"), np.arange(n)])
        order = np.lexsort((bounds, owner))
        bounds, owner = bounds[order], owner[order]
        length = tok.lengths[ids]
        end = np.cumsum(length)
        section, across = attribute(end - length, end, bounds)
        by_section = np.bincount(section, minlength=len(bounds))
        cut = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
        crossing = np.bincount(np.searchsorted(starts, across, "right") - 1, minlength=n)
        return [pa.array(np.diff(starts)), pa.array(np.diff(cut).astype(np.int64)), pa.array(crossing),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(by_section))]

    return fn


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_sections``, ``n_crossing`` and ``section_tokens`` (by line)."""
    ranks = load_ranks(vocabulary)
    return map_texts(docs, text_col, RESULT, lambda: counter(ranks))


def count_field_tokens(docs: DataFrame, vocabulary: str, fields: list[str]) -> DataFrame:
    """As ``count_tokens``, with the named fields as sections (line ends inside a field don't divide it)."""
    ranks = load_ranks(vocabulary)
    docs = clear_names(docs, ["__joined", "__cuts"])
    cols = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields]
    return map_texts(docs.withColumn("__joined", F.to_json(F.array(*cols))), "__joined", RESULT, lambda: field_counter(ranks)).drop("__joined")


def field_counter(ranks: bytes):
    tok = Tokenizer(ranks)

    def fn(texts: pa.Array) -> list[pa.Array]:
        parts = [json.loads(t) if t else [""] for t in texts.to_pylist()]
        whole = ["\n".join(p) for p in parts]
        ids, starts = tok.encode(pa.array(whole, pa.string()))
        total, sections, crossing, per = np.diff(starts), [], [], []
        for k, p in enumerate(parts):
            bounds = np.cumsum([len(x.encode()) + (j < len(p) - 1) for j, x in enumerate(p)])
            length = tok.lengths[ids[starts[k]:starts[k + 1]]]
            end = np.cumsum(length)
            section, across = attribute(end - length, end, bounds)
            sections.append(len(p))
            crossing.append(len(across))
            per.append(np.bincount(section, minlength=len(p)).tolist())
        return [pa.array(total), pa.array(sections, pa.int64()), pa.array(crossing, pa.int64()), pa.array(per, pa.list_(pa.int64()))]

    return fn
