"""Toxicity by a linear-chain conditional random field.

Token labels are derived from document labels: a word, or a word beginning, that stands in many
toxic documents and hardly in others marks its tokens. The CRF learns two labels (toxic or not)
from word and prefix features and label transitions; forward-backward gives each token's
marginal, from which a document's score and the offending character offsets follow.

Every document gets a row. Null and empty texts have no tokens and get the score of a document
without evidence. Repeated rows are scored alike, ties in the training sample are broken by id.
Without labelled documents of both classes the score is the share of toxic ones (0 if none).
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.llm.common import KnownWords, gather, labelled_ids, labelled_sample, map_texts, raw, split_words, translated

#: Characters beyond ASCII that are no letters (marks of a letter go with it).
NO_LETTERS = r"[^\pL\pM\x00-\x7F]"
#: ASCII letters in lower case, one space for any other ASCII character.
ONLY_LETTERS = bytes(b if b >= 128 else b | 32 if chr(b).isalpha() else 32 for b in range(256))
SENTENCE_ENDS = np.isin(np.arange(256), list(b".!?"))
PREFIXES = range(4, 9)
#: A sentence of more words is read as several sequences.
MAX_SEQUENCE = 64
#: Smaller marginals don't count as expected tokens.
FAINT = 0.1
#: Tokens whose label pairs are counted at a time.
STRETCH = 1 << 16
#: Weights nearer to zero are left out of the model.
LEAST_WEIGHT = 0.05
#: Documents that are not, and are, toxic that the model is fitted on, at most.
SAMPLE = (1200, 700)
RESULT = [T.StructField("score", T.DoubleType()), T.StructField("n_toxic_tokens", T.IntegerType()),
          T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])))]


def features(w: str) -> list[str]:
    """The word itself and its beginnings."""
    n = len(w)
    return [f"{w}$", *[w[:k] for k in PREFIXES if n > k]] if w else []


@dataclass
class Tokens:
    starts: np.ndarray   # of documents in the tokens
    word: np.ndarray     # number of each token's word
    words: pa.Array      # the distinct ones
    begin: np.ndarray    # characters from the document's start
    length: np.ndarray
    seq: np.ndarray      # starts of sequences in the tokens, and the end


def tokens(texts: pa.Array) -> Tokens:
    """Every run of letters is a token, whatever stands beside it; a text without any has one empty token."""
    texts = pc.replace_substring_regex(texts, NO_LETTERS, " ")   # a character each, so offsets stay
    starts, word, words, length = split_words(translated(texts, ONLY_LETTERS))
    n = len(word)
    after = np.cumsum(length + 1)
    begin = after - length - 1
    begin -= np.repeat(begin[starts[:-1]] if n else begin, np.diff(starts))
    # one character cuts a token from the next: where a sentence ends there, so does the sequence
    last = np.zeros(n, bool)
    last[starts[1:] - 1] = True
    bytes_ = np.frombuffer(raw(texts)[0], np.uint8)
    ends = last.copy()
    ends[~last] = SENTENCE_ENDS[bytes_[np.frombuffer(ONLY_LETTERS, np.uint8)[bytes_] == 32]]
    sentence = np.cumsum(ends) - ends
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    keep = length > 0
    none = np.bincount(doc[keep], minlength=len(texts)) == 0
    keep[starts[:-1][none]] = True
    word, begin, length, sentence, doc = word[keep], begin[keep], length[keep], sentence[keep], doc[keep]
    starts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
    n = len(word)
    first = np.ones(n + 1, bool)
    first[1:-1] = sentence[1:] != sentence[:-1] if n else first[1:-1]
    seq = np.flatnonzero(first)
    if n:  # long ones in runs
        at = np.arange(n) - np.repeat(seq[:-1], np.diff(seq))
        first[:-1] |= at % MAX_SEQUENCE == 0
        seq = np.flatnonzero(first)
    return Tokens(starts, word, words, begin, length, seq)


class Chain:
    """Forward-backward over many sequences at once; labels 0 and 1, emissions as odds of label 1."""

    def __init__(self, seq: np.ndarray):
        size = np.diff(seq)
        order = np.argsort(-size, kind="stable")
        self.n, self.size, self.start = int(seq[-1]) if len(seq) else 0, size[order], seq[:-1][order]
        self.longest = int(self.size[0]) if len(order) else 0
        self.active = [int(np.searchsorted(-self.size, -t, "left")) for t in range(self.longest)]
        follows = np.ones(self.n, bool)
        follows[seq[:-1]] = False
        self.follows = np.flatnonzero(follows)

    def marginals(self, odds: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each token's probability of label 1, and the two passes."""
        t = np.exp(trans)
        a, b = np.empty(self.n), np.empty(self.n)
        for k in range(self.longest):
            at = self.start[:self.active[k]] + k
            if k == 0:
                n0, n1 = np.ones(len(at)), odds[at]
            else:
                p = a[at - 1]
                n0, n1 = (1 - p) * t[0, 0] + p * t[1, 0], ((1 - p) * t[0, 1] + p * t[1, 1]) * odds[at]
            a[at] = n1 / (n0 + n1)
        for k in range(self.longest - 1, -1, -1):
            m = self.active[k]
            more = self.active[k + 1] if k + 1 < self.longest else 0
            if more < m:
                b[self.start[more:m] + k] = 0.5
            if more:
                at = self.start[:more] + k
                r, e = b[at + 1], odds[at + 1]
                b0, b1 = t[0, 0] * (1 - r) + t[0, 1] * e * r, t[1, 0] * (1 - r) + t[1, 1] * e * r
                b[at] = b1 / (b0 + b1)
        p1, p0 = a * b, 1 - a
        p0 *= 1 - b
        p0 += p1
        p1 /= p0
        return p1, a, b

    def transitions(self, odds: np.ndarray, trans: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Expected counts of the label pairs."""
        t, total = np.exp(trans), np.zeros(4)
        for j in np.array_split(self.follows, 1 + len(self.follows) // STRETCH):
            p, r, e = a[j - 1], b[j], odds[j]
            x = np.stack([(1 - p) * t[0, 0] * (1 - r), (1 - p) * t[0, 1] * e * r, p * t[1, 0] * (1 - r), p * t[1, 1] * e * r])
            total += (x / x.sum(0)).sum(1)
        return total.reshape(2, 2)


@dataclass
class Model:
    """bias and weights: by feature; trans: by label pair; doc: of the document's score."""

    bias: float
    weights: dict[str, float]
    trans: np.ndarray
    doc: np.ndarray       # of the columns of evidence()

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum([get(f, 0.0) for f in features(word.lower())])


def evidence(marg: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """By document: 1, log of 1 + the expected number of toxic tokens (of those with a marginal of
    ``FAINT`` or more, so that length alone is no evidence), the two highest marginals."""
    n, first = len(starts) - 1, starts[:-1]  # a document has one token at least, if an empty one
    if not n:
        return np.zeros((0, 4))
    doc = np.repeat(np.arange(n), np.diff(starts))
    top = np.maximum.reduceat(marg, first)
    at = np.flatnonzero(marg == top[doc])
    rest = marg.copy()
    rest[at[np.unique(doc[at], return_index=True)[1]]] = 0
    return np.stack([np.ones(n), np.log1p(np.bincount(doc, np.where(marg >= FAINT, marg, 0), n)), top, np.maximum.reduceat(rest, first)], 1)


def numbered(bares: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of all words, numbered: their hashes, each one's number, and how many each word has."""
    size = np.fromiter((bool(w) + sum(len(w) > k for k in PREFIXES) for w in bares), np.int64, len(bares))
    hashes = np.fromiter((zlib.crc32(f.encode()) for w in bares for f in features(w)), np.int64, int(size.sum()))
    used, flat = np.unique(hashes, return_inverse=True)
    return used, flat, size


def toxic_words(t: Tokens, flat: np.ndarray, size: np.ndarray, n: int, label: np.ndarray) -> np.ndarray:
    """For each distinct word: does it, or a beginning of it, stand in toxic documents far more than in others?"""
    ptr, m = np.cumsum(size) - size, len(size)
    doc = np.repeat(np.arange(len(label)), np.diff(t.starts))
    hit, miss = np.zeros(n), np.zeros(n)
    for y, total in ((1, hit), (0, miss)):
        for part in np.array_split(np.flatnonzero(label == y), 8):   # of documents, for little memory
            inside = (doc >= part[0]) & (doc <= part[-1]) & (label[doc] == y) if len(part) else np.zeros(len(doc), bool)
            pair = np.unique(doc[inside] * m + t.word[inside])
            d, w = pair // max(1, m), pair % max(1, m)
            unit = gather(flat, ptr[w], size[w])
            pair = np.unique(np.repeat(d, size[w]) * max(1, n) + unit)
            total += np.bincount(pair % max(1, n), minlength=n)
    n1, n0 = label.sum(), (1 - label).sum()
    share = n1 / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(hit > 0, hit * np.log(hit / ((hit + miss) * share)), 0) + np.where(miss > 0, miss * np.log(miss / ((hit + miss) * (1 - share))), 0))
    # beyond chance among so many units, and rare elsewhere
    good = (g > 2 * np.log(max(2, n))) & (hit / n1 > 50 * miss / n0)
    return np.bincount(np.repeat(np.arange(m), size), good[flat], m) > 0


def fit(texts: list[str | None], label: np.ndarray, rounds: int = 15, totals: tuple[int, int] | None = None) -> Model:
    """Fit on a bounded sample of whole texts (repeated texts count once). ``totals``: how many documents
    have label 0 and 1 where the sample was drawn from; by default the sample's shares are taken for theirs."""
    kept = list(dict.fromkeys((x or "", int(y)) for x, y in zip(texts, label)))
    label = np.array([y for _, y in kept], dtype=float)
    if not len(label) or label.min() == label.max():
        p = np.clip(label.mean() if len(label) else 0.0, 1e-6, 1 - 1e-6)
        return Model(-9.0, {}, np.zeros((2, 2)), np.array([np.log(p / (1 - p)), 0.0, 0.0, 0.0]))
    t = tokens(pa.array([x for x, _ in kept], pa.string()))
    bares = [w.lower() for w in t.words.to_pylist()]
    used, flat, size = numbered(bares)
    owner = np.repeat(np.arange(len(size)), size)
    marked = toxic_words(t, flat, size, len(used), label)
    y = (marked[t.word] & (label[np.repeat(np.arange(len(label)), np.diff(t.starts))] > 0)).astype(float)
    chain = Chain(t.seq)
    w, trans, bias = np.zeros(len(used)), np.zeros((2, 2)), np.array([-4.0])
    j = chain.follows
    seen = np.bincount((2 * y[j - 1] + y[j]).astype(np.int8), minlength=4).reshape(2, 2)
    t.begin = t.length = None   # only spans need them
    params, m, v = [w, trans, bias], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]
    n = max(1.0, y.sum())

    def odds():
        return np.exp(np.clip(bias[0] + np.bincount(owner, w[flat], len(size)), -30, 30))[t.word]

    for k in range(1, rounds + 1):
        e = odds()
        marg, a, b = chain.marginals(e, trans)
        by_word = np.bincount(t.word, marg - y, len(size))
        grads = [np.bincount(flat, by_word[owner], len(used)) / n + 1e-4 * w, (chain.transitions(e, trans, a, b) - seen) / n + 1e-2 * trans, np.array([by_word.sum() / n])]
        for i, g in enumerate(grads):  # Adam
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
            params[i] -= 0.4 * (m[i] / (1 - 0.9 ** k)) / (np.sqrt(v[i] / (1 - 0.99 ** k)) + 1e-8)
        del e, marg, a, b
    x = evidence(chain.marginals(odds(), trans)[0], t.starts)
    weight = {int(used[i]): float(w[i]) for i in np.flatnonzero(np.abs(w) > LEAST_WEIGHT)}
    named = {f: weight[h] for b in bares for f in features(b) if (h := zlib.crc32(f.encode())) in weight}
    return Model(float(bias[0]), named, trans, logistic(x, label, weight_of(label, totals)))


def weight_of(label: np.ndarray, totals: tuple[int, int] | None) -> np.ndarray:
    """What each sampled document counts, so that the classes have their shares of ``totals``; 1 on average."""
    if not totals or not min(totals):
        return np.ones(len(label))
    return np.where(label > 0, totals[1] / label.sum(), totals[0] / (1 - label).sum()) * len(label) / sum(totals)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * len(y) * 0.05 * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * len(y) * 0.05 * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          most: tuple[int, int] = SAMPLE) -> Model:
    """A model from at most ``most`` labelled documents with label 0 and 1 (whole texts). In the document's
    score the two classes count by their shares of all labelled ids."""
    count = dict(labelled_ids(labels, label, id_col).groupBy(F.col("lo").cast("int").alias("y")).count().filter("y IN (0, 1)").collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((y, x) for b in batches for y, x in zip(b.column("label").to_pylist(), b.column("text").to_pylist())), key=lambda r: (r[0], r[1] or ""))
        model = fit([x for _, x in rows], np.array([y for y, _ in rows]), totals=(count.get(0, 0), count.get(1, 0)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((model.bias, model.weights, model.trans, model.doc))], pa.binary())], ["model"])

    # the sample, of at most sum(most) texts, meets in one task; the model comes back
    sample = labelled_sample(docs, labels, label, id_col, text_col, most)
    made = sample.coalesce(1).mapInArrow(run, "model binary").first()
    return Model(*pickle.loads(made["model"])) if made else fit([], np.array([]))   # no partitions: no sample


def scorer(model: Model):
    """fn(texts) -> score, number of toxic tokens, spans."""
    def emissions(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.array([model.emission(w) for w in words], float), np.ones(len(words), np.int64)

    known = KnownWords(emissions)

    def fn(texts: pa.Array) -> list[pa.Array]:
        t = tokens(texts)
        made, at, _ = known(t.words, np.bincount(t.word, minlength=len(t.words)))
        odds = np.exp(np.clip(made[at], -30, 30))[t.word]
        marg = Chain(t.seq).marginals(odds, model.trans)[0]
        score = 1 / (1 + np.exp(-np.clip(evidence(marg, t.starts) @ model.doc, -30, 30)))
        bad = np.flatnonzero(marg >= 0.5)
        doc = np.searchsorted(t.starts, bad, "right") - 1
        count = np.bincount(doc, minlength=len(texts)).astype(np.int32)
        cut = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
        span = pa.StructArray.from_arrays([pa.array(t.begin[bad].astype(np.int32)), pa.array((t.begin + t.length)[bad].astype(np.int32))], ["begin", "end"])
        return [pa.array(score), pa.array(count), pa.ListArray.from_arrays(cut, span)]

    return fn


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``n_toxic_tokens`` and ``spans`` (character offsets of
    tokens more likely toxic than not). All input columns stay; ones of these names are renamed."""
    return map_texts(docs, text_col, RESULT, lambda: scorer(model))
