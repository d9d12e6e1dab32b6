"""Benchmark decontamination with SimHash windows, on DataFrame functions only.

A document's windows have the length, in words, of a benchmark item. Both sides become weighted
sets of five-word shingles (lower case, words of letters and digits; weight: times it occurs) with
a 64-bit SimHash. A multi-index of 8 blocks finds every window and item of that length whose
fingerprints differ in at most ``RADIUS`` bits, since some block then differs within its own
share (the shares plus one add up to the radius plus one). The exact weighted Jaccard similarity
of the shingles then decides: 0.8 or more.

A window can only be that similar if most of its shingles stand in some item of its length, so
fingerprints are made of windows with enough of them. That loses nothing: it is what the similarity
asks for. A window starts where an item's shingle starts; any other with enough of them turns into
such a one by moving it right, sharing no fewer (at the end of a text, the last full window is taken).
A text shorter than an item is one window.

Null and empty texts and texts or items under five words have no shingles and match nothing. Repeated
rows and items give one row; an empty side gives an empty result; a null id is an id like any other.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.llm.common import small_side
from contentrisk.operators.tables import free_name, write_table

SHINGLE = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 a bit differs with a chance of 0.15: 9.7 of 64, and over 20 in 2 of 10,000.
RADIUS = 20
BLOCKS, BLOCK_BITS = 8, 8
WORDS = r"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+', 0)"
SHINGLES = ("CASE WHEN size(words) >= 5 THEN transform(sequence(0, size(words) - 5), "
            "i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])) ELSE array() END")


def shares(radius: int = RADIUS) -> list[int]:
    """Bits that each block may differ in: share + 1 adds up to radius + 1 over the blocks."""
    total = radius + 1 - BLOCKS
    if total < 0:
        raise ValueError(f"a radius of {BLOCKS - 1} or more")
    return [total // BLOCKS + (k < total % BLOCKS) for k in range(BLOCKS)]


def fingerprints(shingles: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``fp``: bit b is set if it is in over half the weight ``w`` of the hashes ``h``.

    The 64 counts are held in 32 sums of two 32-bit lanes each.
    """
    lane = 0x0000000100000001
    sums = [F.sum(F.expr(f"(shiftrightunsigned(h, {k}) & {lane}L) * w")).alias(f"s{k}") for k in range(32)]
    counted = shingles.groupBy(*by).agg(*sums, F.sum("w").alias("total"))
    bit = " | ".join(f"IF(2 * (shiftrightunsigned(s{k}, {32 * j}) & 4294967295L) > total, shiftleft(1L, {k + 32 * j}), 0L)"
                     for k in range(32) for j in range(2))
    return counted.select(*by, F.expr(bit).alias("fp"))


def block(k: int) -> str:
    return f"(shiftrightunsigned(fp, {BLOCK_BITS * k}) & {2 ** BLOCK_BITS - 1}L)"


def item_keys(radius: int = RADIUS):
    """(block number, value) under which an item's fingerprint is found: each block's value with
    up to its share of bits turned."""
    # block k with the bits m turned: k * 256 + m is the key of a block of zeros; a literal array, whatever its length
    turned = [k * 2 ** BLOCK_BITS + sum(1 << b for b in bits) for k, share in enumerate(shares(radius))
              for n in range(share + 1) for bits in combinations(range(BLOCK_BITS), n)]
    own = f"(shiftrightunsigned(fp, cast({BLOCK_BITS} * shiftright(t, {BLOCK_BITS}) as int)) & {2 ** BLOCK_BITS - 1}L)"
    return F.explode(F.expr(f"transform(from_json('{turned}', 'array<bigint>'), t -> t ^ {own})"))


def window_keys():
    return F.explode(F.expr("array(" + ", ".join(f"{k * 2 ** BLOCK_BITS}L + {block(k)}" for k in range(BLOCKS)) + ")"))


def with_shingles(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``n_words`` and ``shingles`` (hashes, by place) in place of the text.

    Explode them by explode_outer: for explode Spark infers a filter on the array's size, and below
    these projections that filter would cut the words anew at every place.
    """
    return (df.withColumn("words", F.expr(WORDS.format(text=text)))
            .withColumn("n_words", F.expr("coalesce(size(words), 0)"))
            .withColumn("shingles", F.expr(SHINGLES)).drop("words", text))


def item_shingles(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, length, h, w): the items' weighted shingles. Repeated items count once."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).distinct()
    items = items.withColumn("row", F.xxhash64("item", "text"))
    return (with_shingles(items, "text").select("item", "row", F.col("n_words").alias("length"), F.explode_outer("shingles").alias("h"))
            .filter("h IS NOT NULL").groupBy("item", "row", "length", "h").agg(F.count("*").alias("w")))


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row, length, begin): the windows of documents with enough shingles of items of that length.

    One pass over the texts joins each place's shingle to the items' distinct ones (broadcast if
    few); only hits are shuffled, by document and length.
    """
    wanted = write_table(items.groupBy("h").agg(F.sort_array(F.collect_set("length")).alias("lengths")), "decon-wanted")
    places = with_shingles(docs, "text").select("row", "n_words", F.posexplode_outer("shingles").alias("at", "h"))
    hits = (places.join(small_side(wanted), "h")
            .select("row", "n_words", "at", F.explode("lengths").alias("length"))
            .groupBy("row", "n_words", "length").agg(F.sort_array(F.collect_set("at")).alias("at")))
    # of 2 * m shingles, s shared: s / (2m - s) >= 0.8; m - s windows later the same place is another's
    hits = hits.withColumn("m", F.expr(f"least(length, n_words) - {SHINGLE - 1}"))
    hits = hits.withColumn("need", F.expr(f"greatest(1, cast(ceil({SIMILARITY} * (m + length - {SHINGLE - 1}) / {1 + SIMILARITY} - 1e-9) as int))"))
    begins = ("CASE WHEN size(at) >= need THEN transform(filter(sequence(0, size(at) - need), i -> at[i + need - 1] - at[i] < m), "
              "i -> greatest(0, least(at[i], n_words - length))) ELSE array() END")
    return hits.select("row", "length", "m", F.explode_outer(F.array_distinct(F.expr(begins))).alias("begin")).filter("begin IS NOT NULL")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``row`` (hash of id and text), ``id_col``, ``item_col``, ``similarity`` (the highest of any
    window) and ``begin`` (its first word; the earliest of equal ones), one row a document and item."""
    items = write_table(item_shingles(benchmark, item_col, item_text_col), "decon-items")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("id", "text"))
    found = windows(texts.drop("id"), items).distinct()
    # the shingles of those windows, from the few documents that have them
    by_row = write_table(found.groupBy("row").agg(F.collect_list(F.struct("length", "m", "begin")).alias("windows")), "decon-rows")
    # only their hashes may be broadcast; the window lists, of any length, meet the texts by a shuffle on the hash
    texts = texts.join(small_side(by_row.select("row")), "row", "left_semi").dropDuplicates(["row"])
    own = with_shingles(texts.join(by_row, "row"), "text")
    key = ["row", "length", "begin"]
    parts = (own.select("row", "id", "shingles", F.explode("windows").alias("w"))
             .select("row", "id", "w.length", "w.begin", F.explode_outer(F.expr("slice(shingles, w.begin + 1, w.m)")).alias("h"))
             .groupBy("id", *key, "h").agg(F.count("*").alias("w")))
    parts = write_table(parts, "decon-shingles")
    # candidates: the multi-index, then the whole Hamming distance
    item_fp = write_table(fingerprints(items, ["item", "row", "length"]).withColumnRenamed("row", "item_row"), "decon-item-fp")
    item_index = item_fp.select("item", "item_row", "length", F.col("fp").alias("item_fp"), item_keys().alias("key"))
    item_index = write_table(item_index, "decon-index")
    probe = write_table(fingerprints(parts, key), "decon-window-fp").select(*key, "fp", window_keys().alias("key"))
    near = (probe.join(small_side(item_index), ["length", "key"])
            .filter(F.expr(f"bit_count(fp ^ item_fp) <= {RADIUS}"))
            .select(*key, "item", "item_row").distinct())
    near = write_table(near, "decon-near")
    # exact weighted Jaccard: shared weight over the weight of either
    item_w = items.select(F.col("row").alias("item_row"), "h", F.col("w").alias("iw"))
    shared = (near.join(parts, key).join(item_w, ["item_row", "h"])
              .groupBy("id", *key, "item", "item_row").agg(F.sum(F.least("w", "iw")).alias("shared")))
    of_window = parts.groupBy(*key).agg(F.sum("w").alias("nw"))
    of_item = items.groupBy(F.col("row").alias("item_row")).agg(F.sum("w").alias("ni"))
    scored = (shared.join(of_window, key).join(of_item, "item_row")
              .withColumn("similarity", F.expr("shared / (nw + ni - shared)"))
              .filter(F.col("similarity") >= SIMILARITY - 1e-12))
    best = (scored.groupBy("row", "id", "item")
            .agg(F.max(F.struct("similarity", (-F.col("begin")).alias("b"))).alias("top")))
    return best.select("row", F.col("id").alias(id_col), F.col("item").alias(item_col),
                       F.col("top.similarity").alias("similarity"), (-F.col("top.b")).alias("begin"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    leak = free_name(docs, "leak")
    leaks = write_table(contaminated(docs, benchmark, id_col, text_col).select(F.col("row").alias(leak)).distinct(), "decon-leaks")
    h = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return docs.join(small_side(leaks), h == F.col(leak), "left_anti")
