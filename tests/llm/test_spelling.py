"""Spelling variants against a plain version, and on words of any length."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from contentrisk.llm import spelling


def plain(rows, shortest=5, fewest=3, noise=97):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if noise and h % noise == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            count[w] += 1
    words = {w: n for w, n in count.items() if n >= fewest and len(w) >= shortest}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        k = 0
        while k < len(a) and a[k] == b[k]:
            k += 1
        return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]

    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x), default=None) for w, v in near.items()}
    form = {w: b if b and words[b] >= 2 * words[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def corpus(n=300):
    rng = np.random.default_rng(0)
    stems = ["".join(rng.choice(list("ab\u00e9\u00c9xyz"), int(rng.integers(4, 9)))) for _ in range(60)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(40):
            w = stems[min(int(rng.exponential(12)), 59)]
            if rng.random() < 0.2:
                k = int(rng.integers(0, len(w)))
                w = w[:k] + str(rng.choice(["", "a", "b" + w[k]])) + w[k + 1:]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(words) + "."))
    return rows


def got(df, **kw):
    return {tuple(r) for r in spelling.spelling_variants(df, **kw).collect()}


def test_equals_brute_force(spark, monkeypatch):
    rows = [*corpus(), (None, None), (None, "abcab abcab"), (-1, ""), (-2, "\u00d7\u00f7\u00d7\u00f7\u00d7 \u00df\u00df\u00df\u00df\u00df, \u0100bcde \u4f60\u597dabcde" * 3)]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string").repartition(5)
    want = plain(rows)
    assert len(want) > 300 and sum(f is not None for _, f, *_ in want) > 100
    assert any(root != form for _, form, root, *_ in want if form)
    assert got(df, noise=97) == want
    monkeypatch.setattr(spelling, "BROADCAST_EDGES", 0)     # every level by a shuffle join
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    assert got(df, noise=97) == want


@pytest.mark.parametrize("deep", [5, 6, 7])
def test_words_on_both_sides_of_the_depth(spark, deep):
    rows = corpus(120)
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), noise=None, deep=deep) == plain(rows, noise=None)


def test_long_words(spark):
    rng = np.random.default_rng(1)
    junk = "".join(rng.choice(list("abc"), 3000))
    words = [junk, junk[:7] + "z" + junk[8:], junk[1:], junk + "a", "a" * 48, "a" * 49, "a" * 50]
    rows = [(i, " ".join(words)) for i in range(3 * len(words))] + [(99, junk + " " + "a" * 49)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), noise=None) == plain(rows, noise=None)


def test_empty(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert got(df) == set() and got(df.limit(0)) == set()
    one = spelling.spelling_variants(spark.createDataFrame([(1, "hello hello hello")], "doc_id long, text string"))
    assert [tuple(r) for r in one.collect()] == [("hello", None, "hello", 3, 0, None)]
    assert one.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_crc_of_joined_texts():
    rng = np.random.default_rng(2)
    prefix, word = [rng.bytes(int(rng.integers(0, 12))) for _ in range(200)], [rng.bytes(int(rng.integers(0, 40))) for _ in range(200)]
    made = spelling.Crc32Join()(np.array([zlib.crc32(p) for p in prefix], np.uint32), np.array([zlib.crc32(w) for w in word], np.uint32),
                                np.array([len(w) for w in word]))
    assert made.tolist() == [zlib.crc32(p + w) for p, w in zip(prefix, word)]


def test_letter_runs():
    texts = ["a-b \u00c0\u00ffZ", "", "\u00bf\u0100\u00e9", "\U0001f600x\u4f60y"]
    assert [t.split() for t in spelling.letter_runs(pa.array(texts)).to_pylist()] == [["a", "b", "\u00c0\u00ffz"], [], ["\u00e9"], ["x", "y"]]
