"""Spelling variant grouping by a relational trie frontier.

The words of all texts, counted, form a trie that is kept as a table of edges (depth, node, letter,
child). Every word walks that trie level by level as rows (word, position, node): along its own
letters with no edit, and from each place of them once with a letter replaced or left out. A level is
one join of the frontier with the edges of its depth on node and letter; rows without an edge are
gone, rows whose word is used up at the end of another word are neighbours. Replacements are walked
towards the larger letter only and insertions as the other word's deletions, and of a run of equal
letters the last one is left out, so each pair is met once.

A level's edges are broadcast only if a count shows that they are few, else Spark joins by a shuffle.
Every few levels are written to the shared folder; a lost executor costs those. Nodes are 64-bit hashes of
their prefixes; pairs are checked by their distance at the end, so a collision adds work, not pairs.

A trie as deep as the longest word would cost a join a letter, so words of over ``DEEP`` letters (junk,
mostly) meet by the hashes of their own forms with one letter left out: two words that share one are
near, so no group holds pairs that are not results. Words of ``DEEP`` letters stand on both sides.

Null texts have no words, a null id counts as an empty one, repeated rows count each, ties go to the
smaller word in code-point order, an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.llm.common import raw, slices, split_words, text_array
from contentrisk.operators.tables import write_table

#: Letters of the longest word that walks the trie.
DEEP = 48
#: Levels walked between two written tables.
LEVELS = 3
#: A level's edges are broadcast only if a count shows at most this many (rows of two longs and a letter).
BROADCAST_EDGES = 100_000
#: Words of a partition that starts walks, on average.
WORDS_A_TASK = 20_000
#: Words a counting task holds before it passes its counts on.
HELD_WORDS = 300_000

_ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_LEAD = 0xC3   # UTF-8 lead byte of U+00C0 to U+00FF, and of nothing else


def letter_runs(texts: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case and one space for every byte outside runs of A-Z, a-z, U+00C0 to U+00FF."""
    data, bounds = raw(texts)
    b = np.frombuffer(data.translate(_ASCII_LOWER), np.uint8).copy()
    lead = b == _LEAD
    letter = _LETTER[b] | lead
    letter[1:] |= lead[:-1]
    b[~letter] = 32
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(b.tobytes()))


class Crc32Join:
    """crc32(prefix + word) from the crc32 of each: appending n bytes is a linear map of the prefix's."""

    def __init__(self):
        self.tables: dict[int, np.ndarray] = {}

    def table(self, n: int) -> np.ndarray:
        if n not in self.tables:
            zeros = bytes(n)
            zero = zlib.crc32(zeros, 0)
            bits = [zlib.crc32(zeros, 1 << k) ^ zero for k in range(32)]
            t = np.zeros((4, 256), np.uint32)
            for part in range(4):
                for k in range(8):
                    t[part, 1 << k:2 << k] = t[part, :1 << k] ^ np.uint32(bits[8 * part + k])
            self.tables[n] = t
        return self.tables[n]

    def __call__(self, prefix: np.ndarray, word: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``size``: bytes of each word."""
        out = word.copy()
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order])) + 1
        for own in np.split(order, cuts):
            if len(own):
                t, p = self.table(int(size[own[0]])), prefix[own]
                out[own] ^= t[0][p & 255] ^ t[1][(p >> 8) & 255] ^ t[2][(p >> 16) & 255] ^ t[3][p >> 24]
        return out


def count_words(docs: DataFrame, id_col: str, text_col: str, shortest: int, noise: int | None) -> DataFrame:
    """(word, n): words of at least ``shortest`` letters and how often they stand in all texts.

    ``noise``: if it divides the crc32 of ``<id>:<word>``, the place's word loses one letter, chosen by
    that number. Tasks count first and pass on one row a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, join = Counter(), Crc32Join()

        def flush():
            got = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return got

        for batch in batches:
            for part in slices(batch, "text"):
                starts, code, words, _ = split_words(letter_runs(text_array(part.column("text"))))
                words = words.to_pylist()
                times = np.bincount(code, minlength=len(words))
                length = np.array([len(w) for w in words], np.int64)
                if noise:
                    encoded = [w.encode() for w in words]
                    crc = np.array([zlib.crc32(w) for w in encoded], np.uint32)
                    size = np.array([len(w) for w in encoded], np.int64)
                    ids = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in part.column("id").to_pylist()]
                    at = np.flatnonzero(length[code] > 0)
                    own = np.repeat(np.array(ids, np.uint32), np.diff(starts))[at]
                    h = join(own, crc[code[at]], size[code[at]])
                    hit = np.flatnonzero(h % noise == 0)
                    for c, k in zip(code[at[hit]].tolist(), h[hit].tolist()):
                        times[c] -= 1
                        w, k = words[c], k % len(words[c])
                        if len(w) > shortest:
                            held[w[:k] + w[k + 1:]] += 1
                for c in np.flatnonzero((times > 0) & (length >= shortest)).tolist():
                    held[words[c]] += int(times[c])
                if len(held) > HELD_WORDS:
                    yield flush()
        yield flush()

    found = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def prefix_node(length: str):
    """The trie node of a word's first ``length`` letters."""
    return F.expr(f"xxhash64(substring(word, 1, {length}))")


def letter_at(at: str):
    """The letter behind the first ``at`` letters of a word; behind the last, the empty text."""
    return F.expr(f"substring(word, {at} + 1, 1)")


def trie_edges(words: DataFrame) -> DataFrame:
    """(depth, node, letter, child) of the words' trie."""
    steps = words.select("word", F.explode(F.expr("sequence(0, length(word) - 1)")).alias("depth"))
    return steps.select("depth", prefix_node("depth").alias("node"), letter_at("depth").alias("letter"), prefix_node("depth + 1").alias("child")).distinct()


def walked_pairs(words: DataFrame) -> DataFrame:
    """(word, other): pairs one letter apart, each one way round, by walking the trie of ``words``."""
    deepest = words.agg(F.max(F.length("word"))).first()[0]
    if deepest is None:
        return words.select("word", F.col("word").alias("other"))
    edges = write_table(trie_edges(words).repartition("depth"), "spelling-edges")
    count = {r["depth"]: r["count"] for r in edges.groupBy("depth").count().collect()}   # DEEP rows at most

    def level(depth: int) -> DataFrame:
        e = edges.filter(F.col("depth") == depth).select("node", "letter", "child")
        return F.broadcast(e) if count.get(depth, 0) <= BROADCAST_EDGES else e

    frontier, tables = None, []
    for depth in range(deepest):
        # a letter left out, of equal ones in a row the last
        now = (words.filter((F.length("word") > depth) & (letter_at(str(depth)) != letter_at(str(depth + 1))))
               .select("word", F.lit(depth + 1).alias("at"), prefix_node(str(depth)).alias("node")))
        if frontier is not None:
            now = now.unionByName(frontier)
        # rows whose word is used up have no next letter, meet no edge and are carried along
        step = (now.withColumn("letter", letter_at("at")).join(level(depth), ["node", "letter"], "left")
                .filter("child IS NOT NULL OR at = length(word)")
                .select("word", F.expr("IF(child IS NULL, at, at + 1)").alias("at"), F.coalesce("child", "node").alias("node")))
        # a letter replaced by a larger one: an edge beside the word's own path
        beside = (words.filter(F.length("word") > depth).select("word", prefix_node(str(depth)).alias("node"), letter_at(str(depth)).alias("own"))
                  .join(level(depth), "node").filter("letter > own").select("word", F.lit(depth + 1).alias("at"), F.col("child").alias("node")))
        frontier = step.unionByName(beside)
        if depth % LEVELS == LEVELS - 1 or depth == deepest - 1:
            written = write_table(frontier, f"spelling-level{depth}")
            tables.append(written.filter("at = length(word)"))
            frontier = written.filter("at < length(word)")
    ended = tables[0]
    for t in tables[1:]:
        ended = ended.unionByName(t)
    ends = words.select(F.col("word").alias("other"), F.xxhash64("word").alias("node"))
    return ended.join(ends, "node").select("word", "other")


def shared_form_pairs(words: DataFrame) -> DataFrame:
    """(word, other): pairs of (long) words one letter apart, each one way round, by equal hashes of
    the words with one letter left out (or none: the shorter word of a pair)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 0x9E3779B97F4A7C15
        back = pow(base, -1, 1 << 64)
        for batch in batches:
            for word, me in zip(batch.column("word").to_pylist(), batch.column("me").to_pylist()):
                letters = np.array([ord(c) for c in word], np.uint64) + np.uint64(1)
                power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(word) - 1, base, np.uint64)]))
                sums = np.concatenate([[np.uint64(0)], np.cumsum(letters * power)])
                # without letter i the letters behind it move down by one place
                without = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(back)
                size = np.full(len(word) + 1, len(word) - 1, np.int64)
                size[-1] = len(word)
                hashes = np.concatenate([without, sums[-1:]]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), me, np.int64)), pa.array(size), pa.array(hashes)], ["me", "size", "form"])

    named = words.select("word", F.xxhash64("word").alias("me"))
    forms = write_table(named.mapInArrow(run, "me long, size long, form long").distinct(), "spelling-forms")
    pairs = (forms.join(forms.select(F.col("me").alias("other_me"), "size", "form"), ["size", "form"])
             .filter("me < other_me").select("me", "other_me").distinct())
    return (pairs.join(named, "me").join(named.select(F.col("word").alias("other"), F.col("me").alias("other_me")), "other_me")
            .select("word", "other"))


def near_words(words: DataFrame, deep: int = DEEP) -> DataFrame:
    """(word, other), both ways round, of all words that are one inserted, deleted or replaced letter
    apart. ``words``: a written table of distinct words."""
    pairs = walked_pairs(words.filter(F.length("word") <= deep))
    long_words = words.filter(F.length("word") >= deep)
    if not long_words.isEmpty():
        pairs = pairs.unionByName(shared_form_pairs(long_words).filter(F.greatest(F.length("word"), F.length("other")) > deep))
    pairs = write_table(pairs.filter(F.levenshtein("word", "other", 1) == 1), "spelling-pairs")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))


def variant_groups(words: DataFrame, times: int = 2, deep: int = DEEP) -> DataFrame:
    """``words`` (word, n; distinct words) with each word's commoner spelling.

    ``form``: of the near words that with the largest n (the first of ties), if that is at least
    ``times`` the word's own, else null; ``form_n`` its n; ``n_near`` the number of near words; ``root``
    the last word of the chain of forms (n grows by ``times`` a step, so there are no cycles).
    """
    words = write_table(words.repartition(max(1, -(-words.count() // WORDS_A_TASK)), "word"), "spelling-words")
    near = (near_words(words, deep).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
            .groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("least"), "other")).alias("best")))
    formed = words.join(near, "word", "left").withColumn("own", -F.col("best.least") >= times * F.col("n"))
    formed = write_table(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.expr("IF(own, best.other, NULL)").alias("form"),
                                       F.expr("IF(own, -best.least, NULL)").alias("form_n")), "spelling-forms")
    # each round doubles the steps taken; a chain has at most log(n of the commonest / n of the rarest) of them
    low, high = formed.agg(F.min("n"), F.max("n")).first()
    chain = int(np.log(high / low) / np.log(times)) if high else 0
    roots = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for k in range(max(0, chain - 1).bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = write_table(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"spelling-roots{k}")
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, fewest: int = 3,
                      times: int = 2, noise: int | None = None, deep: int = DEEP) -> DataFrame:
    """``variant_groups`` of the words of at least ``shortest`` letters that stand at least ``fewest`` times in all texts."""
    words = count_words(docs, id_col, text_col, shortest, noise).filter(F.col("n") >= fewest)
    return variant_groups(write_table(words, "spelling-counts"), times, deep)
