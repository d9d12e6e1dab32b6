"""Quality by a generalised additive model with pairwise interactions.

Numbers about a text (``NAMES``) are cut into bins. Shallow trees are boosted in turn, one feature
after the other and round after round, each on its feature's bins only, so the sum of a feature's
trees is a table with one number a bin; then the pairs whose bins explain most of what is left
get tables of two dimensions the same way. A score is the logistic of a sum of table entries.

Every document gets a row. Null and empty texts are texts without words: their numbers are zero.
Repeated rows are scored alike; ties in the training sample are broken by id; columns with a
result's name are renamed. Without labelled documents of both classes the score is the share of 1s.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from contentrisk.llm.common import labelled_sample, map_texts, raw, split_words, translated

NAMES = ("words", "chars per word", "upper", "digits", "marks", "symbols", "bars", "exclamations", "non-ASCII", "lines per word",
         "distinct words", "top word", "repeats of the word before", "repeats of the second before", "capital words", "words ending in symbols", "words without letters", "sentence ends")
SPACES = bytes.maketrans(b"\n\t\r", b"   ")
#: Documents with label 0 and 1 that the model is fitted on, at most.
SAMPLE = (3000, 3000)
RESULT = [T.StructField("score", T.DoubleType())]


def classes() -> np.ndarray:
    kind = np.zeros((7, 256), np.uint8)
    for b in range(256):
        c = chr(b)
        for k, is_ in enumerate(("A" <= c <= "Z", "0" <= c <= "9", c in ".,;:'\"()-?", c in "#$%&*+/<=>@[\\]^_`{}~", c == "|", c == "!", b >= 128)):
            kind[k, b] = is_
    return kind


KIND = classes()


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` for each text, over the whole text."""
    n = len(texts)
    data, bounds = raw(texts)
    codes = np.frombuffer(data, np.uint8)
    size = np.maximum(np.diff(bounds), 1)
    x = np.zeros((n, len(NAMES)))

    def by_text(flags, cuts):  # sums between cuts
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[cuts])

    for k in range(len(KIND)):
        x[:, 2 + k] = by_text(KIND[k][codes], bounds) / size
    lines = by_text(codes == 10, bounds)
    starts, word, distinct, length = split_words(translated(texts, SPACES))
    full = length > 0
    cuts = np.concatenate([[0], np.cumsum(full)])[starts]
    word, length = word[full], length[full]
    doc, m = np.repeat(np.arange(n), np.diff(cuts)), len(distinct)
    words = np.diff(cuts)
    some = np.maximum(words, 1)
    x[:, 0], x[:, 1], x[:, 9] = np.log1p(words), by_text(length, cuts) / some, lines / some
    pair, times = np.unique(doc * m + word, return_counts=True)
    of = pair // max(1, m)
    x[:, 10] = np.bincount(of, minlength=n) / some
    top = np.zeros(n)
    np.maximum.at(top, of, times)
    x[:, 11] = top / some
    for k, col in ((1, 12), (2, 13)):
        same = np.zeros(len(word), bool)
        same[k:] = (word[k:] == word[:-k]) & (doc[k:] == doc[:-k]) if len(word) > k else False
        x[:, col] = by_text(same, cuts) / some
    flag = lambda pattern: pc.match_substring_regex(distinct, pattern).to_numpy(zero_copy_only=False)[word]
    for col, pattern in ((14, r"^\PL*\p{Lu}\p{Lu}[\PL\p{Lu}]*$"), (15, r"[#$%&*~^|]$"), (16, r"^\PL+$"), (17, r"[.!?]$")):
        x[:, col] = by_text(flag(pattern), cuts) / some
    return x


@dataclass
class Model:
    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        f = np.full(len(x), self.base)
        for k, t in enumerate(self.tables):
            f += t[b[:, k]]
        for i, j, t in self.pairs:
            f += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float = 1.0) -> np.ndarray:
    """A shallow tree over ordered bins: the cut with the largest gain, then each side's."""
    out = np.full(len(g), g.sum() / (h.sum() + ridge))
    if not depth or len(g) < 2:
        return out
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl ** 2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge)
    cut = int(np.argmax(gain)) + 1
    if gain[cut - 1] <= g.sum() ** 2 / (h.sum() + ridge) + 1e-12:
        return out
    return np.concatenate([tree(g[:cut], h[:cut], depth - 1, ridge), tree(g[cut:], h[cut:], depth - 1, ridge)])


def quadrants(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """A tree of one cut on each axis of a table: its gain, and its values."""
    def corners(a):
        c = a.cumsum(0).cumsum(1)
        ll, l_, _l = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return ll, l_ - ll, _l - ll, c[-1, -1] - l_ - _l + ll
    gs, hs = corners(g), corners(h)
    gain = sum(a ** 2 / (b + ridge) for a, b in zip(gs, hs))
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [a[i, j] / (b[i, j] + ridge) for a, b in zip(gs, hs)]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + ridge)), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, bins: int = 32, pairs: int = 6, rate: float = 0.15) -> Model:
    share = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(len(NAMES))]
    model = Model(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges])
    if not len(y) or y.min() == y.max():
        return model
    b, f = model.bins(x), np.full(len(y), model.base)
    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            p = 1 / (1 + np.exp(-f))
            step = rate * tree(np.bincount(b[:, k], y - p, len(table)), np.bincount(b[:, k], p * (1 - p), len(table)), 2)
            table += step
            f += step[b[:, k]]
    size = [len(t) for t in model.tables]
    both = {(i, j): b[:, i] * size[j] + b[:, j] for i, j in combinations(range(len(NAMES)), 2)}

    def table_of(i, j):
        p = 1 / (1 + np.exp(-f))
        at = both[i, j]
        return quadrants(np.bincount(at, y - p, size[i] * size[j]).reshape(size[i], size[j]), np.bincount(at, p * (1 - p), size[i] * size[j]).reshape(size[i], size[j]))

    best = sorted(both, key=lambda ij: (-table_of(*ij)[0], ij))[:pairs]
    model.pairs = [(i, j, np.zeros((size[i], size[j]))) for i, j in best]
    for _ in range(rounds // 2):
        for i, j, table in model.pairs:
            step = rate * table_of(i, j)[1]
            table += step
            f += step[b[:, i], b[:, j]]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          most: tuple[int, int] = SAMPLE) -> Model:
    """A model from the features of at most ``most`` labelled documents with label 0 and 1 (whole
    texts). The base is that of the sample, in which both labels count as they were drawn: up to ``most``
    of each, so a score of a half is where a text is as likely of either label, not of the commoner one."""
    fields = [T.StructField("x", T.ArrayType(T.DoubleType()))]

    def make():
        return lambda texts: [pa.array(list(features(texts)), pa.list_(pa.float64()))]

    sample = labelled_sample(docs, labels, label, id_col, text_col, most)
    got = map_texts(sample, "text", fields, make).select("label", "x").collect()
    rows = sorted((tuple(r["x"]), r["label"]) for r in got)
    return fit(np.array([x for x, _ in rows]).reshape(len(rows), len(NAMES)), np.array([y for _, y in rows], float))


def score_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``: 0 to 1, higher where label 1 is likelier."""

    def make():
        return lambda texts: [pa.array(model.score(features(texts)))]

    return map_texts(docs, text_col, RESULT, make)
