"""Licence scans with a positional index of rare words.

A template is looked up by its rarest words, those with the highest IDF over the whole corpus: each
place of one in a file votes for the place where the template would begin. Votes of two different words or more
for one beginning (the relative positions intersect there) make a candidate; it counts if enough of the template's
words, by IDF, stand in their places and its mandatory key phrases stand within it. Where most rows hold a notice,
or the table is small, IDF weighs the notice's own words least: so enough words by their mere count will do as well.
Each template has as many voting words as it takes that two stand in place wherever it counts, so neither other
notices in the file nor a file's length lose one. The base phrases are searched at every place besides; labels found
by templates are added to theirs.

Words: ASCII letters lower-cased, everything else in ASCII but digits divides. Null and empty texts
have no words, no labels, null places and the score 0. Repeated rows are scanned alike; an empty
table gives no rows. Columns with a result's name are renamed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.llm.common import map_texts, slices, split_words, text_array, translated

# The base phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Label, wording of the notice, key phrases it must hold.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2", "this program is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
)
#: Share of a template's words that must stand in their places, by IDF or, where that falls short, by count.
LEAST = 0.6
#: Candidates whose words are compared at a time.
STRETCH = 1 << 16
RESULT = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
          T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
          T.StructField("score", T.DoubleType())]

VOCABULARY = sorted({w for p, _ in BASE for w in p.split()} | {w for _, t, _ in TEMPLATES for w in t.split()})
CODE = {w: i for i, w in enumerate(VOCABULARY)}
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def coded(phrase: str) -> list[int]:
    return [CODE[w] for w in phrase.split()]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each word's number in the licence vocabulary (-1: none), and the texts' bounds among the words."""
    starts, word, distinct, _ = split_words(translated(texts, TABLE))
    code = pc.fill_null(pc.index_in(distinct, value_set=pa.array(VOCABULARY)), -1).to_numpy(zero_copy_only=False)
    is_word = pc.greater(pc.binary_length(distinct), 0).to_numpy(zero_copy_only=False)[word]
    before = np.concatenate([[0], np.cumsum(is_word)])
    return code[word][is_word].astype(np.int64), before[starts]


def places(code: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Where the phrase's words stand consecutively (over bounds of texts, too)."""
    at = np.flatnonzero(code[:len(code) - len(phrase) + 1] == phrase[0]) if len(code) >= len(phrase) else np.zeros(0, np.int64)
    for k, c in enumerate(phrase[1:], 1):
        at = at[code[at + k] == c]
    return at


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each licence word stands, and how many documents there are. Tasks count
    by slice; what comes back is one row a licence word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(VOCABULARY) + 1, np.int64)
        for batch in batches:
            for one in slices(batch, "text"):
                code, bounds = words(text_array(one.column("text")))
                doc = np.repeat(np.arange(one.num_rows), np.diff(bounds))
                hit = code >= 0
                pair = np.unique(doc[hit] * len(VOCABULARY) + code[hit])
                total[:-1] += np.bincount(pair % len(VOCABULARY), minlength=len(VOCABULARY))
                total[-1] += one.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["code", "n"])

    got = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(len(VOCABULARY) + 1, np.int64)
    for r in got:
        df[r["code"]] = r["n"]
    return df[:-1], int(df[-1])


def voters(own: np.ndarray, measures: list[np.ndarray]) -> np.ndarray:
    """A template's rarest words (by the first measure of its places), as few as leave no way to reach
    ``LEAST`` in any measure with fewer than two of them in place: the others and the heaviest one fall short."""
    distinct, at = np.unique(own, return_inverse=True)
    order = np.argsort(-measures[0][np.unique(own, return_index=True)[1]], kind="stable")
    held = [np.bincount(at, m)[order] / m.sum() for m in measures]
    for k in range(2, len(order)):
        if all(h[k:].sum() + h[:k].max() < LEAST - 1e-9 for h in held):
            return distinct[order[:k]]
    return distinct


class Scanner:
    def __init__(self, df: np.ndarray, n: int):
        self.idf = np.log((n + 1) / (df + 1))
        self.base = [(coded(p), label) for p, label in BASE]
        self.templates = [(label, np.array(coded(t)), [coded(k) for k in keys]) for label, t, keys in TEMPLATES]
        self.weights = [np.maximum(self.idf[t], 1e-3) for _, t, _ in self.templates]
        self.voters = [voters(own, [w, np.ones(len(own))]) for (_, own, _), w in zip(self.templates, self.weights)]

    def found(self, code: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(label, files, shares) of the templates in the files that begin at ``bounds`` in the words."""
        gap, files = max(len(own) for _, own, _ in self.templates), len(bounds) - 1
        hit = np.flatnonzero(code >= 0)
        at = hit + gap * np.searchsorted(bounds, hit, "right")   # with a gap around each file
        spaced = np.full(len(code) + gap * (files + 1), -1, np.int16)
        spaced[at] = code[hit]
        first = bounds[:-1] + gap * np.arange(files)
        at = at[np.argsort(code[hit], kind="stable")]
        cut = np.searchsorted(np.sort(code[hit]), np.arange(len(VOCABULARY) + 1))
        for (label, own, keys), weight, voting in zip(self.templates, self.weights, self.voters):
            votes = [np.unique(np.concatenate([at[cut[c]:cut[c + 1]] - q for q in np.flatnonzero(own == c)])) for c in voting.tolist()]
            begin, by = np.unique(np.concatenate(votes), return_counts=True)
            for b in np.array_split(begin[by > 1], 1 + len(begin) // STRETCH):   # in bounded runs
                same = spaced[b[:, None] + np.arange(len(own))] == own
                share, plain = (same * weight).sum(1) / weight.sum(), same.mean(1)
                share = np.where(share >= LEAST, share, plain)
                keep = share >= LEAST
                b, share = b[keep], share[keep]
                for k in keys:
                    span = np.lib.stride_tricks.sliding_window_view(spaced[b[:, None] + np.arange(len(own))], len(k), axis=1)
                    keep = (span == np.array(k)).all(2).any(1)
                    b, share = b[keep], share[keep]
                # a beginning may lie in the gap before its file
                yield label, np.searchsorted(first, b, "right") - 1, share

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        code, bounds = words(texts)
        n = len(texts)
        count, first, last = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
        base: list[set] = [set() for _ in range(n)]
        for phrase, label in self.base:
            at = places(code, phrase)
            doc = np.searchsorted(bounds, at, "right") - 1
            keep = at + len(phrase) <= bounds[doc + 1]
            at, doc = at[keep], doc[keep]
            count += np.bincount(doc, minlength=n)
            for d, p in zip(doc.tolist(), (at - bounds[doc]).tolist()):
                first[d] = p if first[d] < 0 else min(first[d], p)
                last[d] = max(last[d], p)
                base[d].add(label)
        labels, score = [set(b) for b in base], np.array([1.0 if b else 0.0 for b in base])
        for label, doc, share in self.found(code, bounds):
            np.maximum.at(score, doc, share)
            for d in np.unique(doc).tolist():
                labels[d].add(label)
        where = lambda x: pa.array(x, pa.int64(), mask=x < 0)
        joined = lambda x: pa.array([",".join(sorted(s)) for s in x], pa.string())
        return [pa.array(np.diff(bounds).astype(np.int64)), pa.array(count), where(first), where(last), joined(base), joined(labels), pa.array(score)]


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels and score (1 with a
    base phrase, else the best template's share of words in place: by IDF if that suffices, else by count). Reads the texts twice."""
    df, n = document_frequencies(docs, text_col)
    return map_texts(docs, text_col, RESULT, lambda: Scanner(df, n))
