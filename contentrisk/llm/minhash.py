"""Document fingerprints by MinHash, and near-duplicates by them.

A text's shingles of ``SHINGLE`` words (A-Z in lower case, cut at white space; a shorter text is one
shingle, a text without words has none) are hashed to 32 bits, and ``PERMUTATIONS`` universal hashes
x -> (a * x + b) >> 32 of them give the signature: each one's least value. Two signatures agree in about
that share of their values that the shingle sets share (Jaccard); 64 values err by 0.06.

Near-duplicates: distinct texts meet in Spark by the bands of their signatures (``BANDS`` bands; at 0.8
Jaccard all of them are missed by 2 in 10,000 pairs). In a bucket a forest links what agrees in enough
values, of any size, so that no group's pairs are emitted; its components are groups of candidates. Only their texts'
shingle sets are built, and within a group exact Jaccard decides, again by a forest, tile by tile
where a group is large. Copies are one row until the end.

``with_next``: each document beside the one that follows it. Documents are sorted by range, all rows of a
task but its last meet their successor there, and the tasks' last rows meet the first rows of the tasks behind
by a join.

Null texts count as empty; empty texts have a signature of their own (all ones) and are alike. Rows of one
id follow each other by a hash of their texts; repeated rows are alike in all results. Null ids come
first, and have no name as a component's least id. An empty table gives no rows; a table of one row is its own
successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contentrisk.llm.common import (connected_components, dealt, forest, in_tiles, lookup, run_starts, slices, small_side,
                                    split_words, text_array, translated, whole_runs)
from contentrisk.operators.tables import write_table

SHINGLE, PERMUTATIONS, BANDS = 5, 64, 16
SIMILARITY = 0.8
#: Share of equal values from which two texts are candidates: 0.8 less three deviations.
CANDIDATE = 0.65
#: Texts of a group that are compared in one step with as many others.
TILE = 512

_SPACE = bytes(32 if chr(b).isspace() and b < 128 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_rng = np.random.default_rng(20_24)
_A = _rng.integers(0, 1 << 64, PERMUTATIONS, np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 64, PERMUTATIONS, np.uint64)
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(64)]
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit hashes (as uint64) of all texts' shingles, one text after the other, and how many each text has."""
    starts, code, words, _ = split_words(translated(texts, _SPACE))
    hashed = np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in words.to_pylist()], np.uint64)
    empty = np.array([not w for w in words.to_pylist()], bool)
    kept = ~empty[code] if len(code) else np.zeros(0, bool)
    total = np.concatenate([[0], np.cumsum(kept)])
    starts = total[starts]                       # in words that are not empty
    w = hashed[code[kept]]
    size = np.diff(starts)
    count = np.where(size >= shingle, size - shingle + 1, np.minimum(size, 1))
    ends = np.cumsum(count)
    at = np.repeat(starts[:-1] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
    last = np.repeat(starts[1:], count)
    h = np.zeros(len(at), np.uint64)
    for k in range(shingle):
        own = at + k < last
        h[own] += w[(at + k)[own]] * _POWERS[k]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h >> np.uint64(32), count


def signatures(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """A row of PERMUTATIONS 32-bit values for each text."""
    h, count = shingle_hashes(texts, shingle)
    out = np.full((len(texts), PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    own = np.flatnonzero(count)
    if len(own):
        first = (np.cumsum(count) - count)[own]
        v = np.empty_like(h)
        for k in range(PERMUTATIONS):
            np.multiply(h, _A[k], out=v)
            v += _B[k]
            out[own, k] = np.minimum.reduceat(v, first) >> np.uint64(32)   # the order is that of the high bits
    return out


def hex_of(sig: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in sig.astype(">u4")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal values, row by row."""
    return (a == b).mean(axis=1)


#: What stands beside each id, as Arrow types: of a row and its successor, and of a task's first and last row.
PAIR = [("n_chars", pa.int64()), ("text_sha256", pa.string()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
EDGE = [("task", pa.int64()), ("first_id", None), ("first_hash", pa.int64()), ("first_text", pa.string()),
        ("last_id", None), ("last_hash", pa.int64()), ("last_text", pa.string())]
_SQL = {pa.int64(): "long", pa.float64(): "double", pa.string(): "string"}


def sql_schema(fields: list, id_type: str) -> str:
    return ", ".join(f"{name} {_SQL[t] if t else id_type}" for name, t in fields)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the first code points of ``following``, as many or all."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def compared(texts: list[str], sig: np.ndarray, following: list[str], next_sig: np.ndarray) -> list[pa.Array]:
    """The columns of PAIR."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    edit_sig = signatures(pa.array(changed, pa.string()))
    made = [[len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in texts],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed], hex_of(sig), hex_of(edit_sig), likeness(sig, edit_sig), likeness(sig, next_sig)]
    return [pa.array(values, t) for values, (_, t) in zip(made, PAIR)]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, *PAIR) of every row: the text's fingerprint, that of the text with its last quarter taken from
    the document that follows by id (after the last: the first), and how alike they are."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # equal rows may stand on several tasks, so one of many copies is no task's whole load; texts travel packed
    order = ["id", "hash", "salt"]
    keyed = rows.select("id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("salt"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch, "text"):
                packed = pa.array([squeeze(t.encode()) for t in part.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in order], packed], [*order, "packed"])

    in_order = keyed.mapInArrow(pack, f"id {kind}, hash long, salt long, packed binary").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = schema = None   # of first and last: (id, hash, text, signature)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            schema = pa.schema([(name, t or batch.schema.field("id").type) for name, t in [("id", None), *PAIR, *EDGE]])
            for part in slices(batch, "packed", 1 << 19):
                text = [unpack(t).decode() for t in part.column("packed").to_pylist()]
                ids, hashes, sig = part.column("id").to_pylist(), part.column("hash").to_pylist(), signatures(pa.array(text, pa.string()))
                if last is None:
                    first = (ids[0], hashes[0], text[0])
                else:
                    ids, text, sig = [last[0], *ids], [last[2], *text], np.concatenate([last[3], sig])
                n, last = len(text) - 1, (ids[-1], hashes[-1], text[-1], sig[-1:])
                if n:
                    got = compared(text[:n], sig[:n], text[1:], sig[1:])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[:n], schema.field("id").type), *got, *[pa.nulls(n, f.type) for f in list(schema)[len(PAIR) + 1:]]], schema=schema)
        if last is not None:   # the last row's successor stands on another task
            yield pa.RecordBatch.from_pylist([dict(zip([name for name, _ in EDGE], [TaskContext.get().partitionId(), *first, *last[:3]]))], schema)

    found = write_table(in_order.mapInArrow(run, f"id {kind}, {sql_schema(PAIR, kind)}, {sql_schema(EDGE, kind)}"), "minhash-next")
    edges = found.filter("task IS NOT NULL")
    # in one place, one narrow row a task: whose rows follow whose
    by = Window.orderBy("first_id", "first_hash", "last_id", "last_hash", "task")
    ahead = edges.select("task", F.coalesce(F.lead("task").over(by), F.first("task").over(by)).alias("next_task"))
    meet = (edges.select("task", F.col("last_id").alias("id"), F.col("last_text").alias("text")).join(ahead, "task")
            .join(edges.select(F.col("task").alias("next_task"), F.col("first_text").alias("following")), "next_task").select("id", "text", "following"))

    def run_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                sig, next_sig = signatures(row.column("text")), signatures(row.column("following"))
                got = compared(row.column("text").to_pylist(), sig, row.column("following").to_pylist(), next_sig)
                yield pa.RecordBatch.from_arrays([row.column("id"), *got], ["id", *[name for name, _ in PAIR]])

    last_rows = meet.mapInArrow(run_edges, f"id {kind}, {sql_schema(PAIR, kind)}")
    return found.filter("task IS NULL").select(*last_rows.columns).unionByName(last_rows)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_sha256, fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = text_array(part.column("text"))
                sha = [hashlib.sha256(t.encode()).hexdigest() for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sha, pa.string()), pa.array(hex_of(signatures(texts, shingle)), pa.string())],
                                                 ["id", "text_sha256", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text_sha256 string, fingerprint string")


def band_links(classes: DataFrame, candidate: float, tile: int = TILE) -> DataFrame:
    """(a, b): links among ``classes`` (class long, fingerprint binary) that connect those which share a
    band and agree in the share ``candidate`` of their values as all such pairs do."""
    wide = 4 * PERMUTATIONS // BANDS
    bands = F.expr(f"explode(transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(fingerprint, b * {wide} + 1, {wide}))))")
    keys = classes.select(bands.alias("key"), "class").repartition("key").sortWithinPartitions("key")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of keys that stand more than once."""
        for table in whole_runs(batches, ["key"]):
            key = table.column("key").to_numpy()
            same = np.concatenate([[False], key[1:] == key[:-1], [False]])
            yield from table.filter(pa.array(same[1:] | same[:-1])).to_batches()

    met = write_table(keys.mapInArrow(shared, "key long, class long"), "minhash-bands")
    # one byte of each value is enough to tell the share of equal ones (1 in 256 are equal by chance)
    low = F.expr(f"unhex(array_join(transform(sequence(1, {PERMUTATIONS}), k -> hex(substring(fingerprint, 4 * k, 1))), ''))")
    members = dealt(met, ["key"], "class", tile).join(classes.select("class", low.alias("low")), "class")
    members = members.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "class").select("key", "x", "y", "class", "low")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["key", "x", "y"]):
            own = table.column("class").to_numpy()
            low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint8).reshape(-1, PERMUTATIONS)
            first = run_starts([table.column(c).to_numpy() for c in ("key", "x", "y")])
            i, j = forest(first, len(own), lambda x, y: (low[x] == low[y]).mean(axis=1) >= candidate)
            yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(own[j])], ["a", "b"])

    return members.mapInArrow(linked, "a long, b long").distinct()


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Is the Jaccard similarity of two sorted sets at least ``similarity``?"""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < similarity * len(large):
        return False
    if not len(large):
        return True
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return both >= similarity * (len(small) + len(large) - both)


def verified_links(docs: DataFrame, text_col: str, groups: DataFrame, similarity: float, tile: int, shingle: int) -> DataFrame:
    """(a, b): links of Jaccard similarity that connect each group's texts as all of them do. ``groups``: a
    written table (class, text_sha256, group, size) of distinct texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, count = shingle_hashes(text_array(part.column("text")), shingle)
                made = [np.unique(x).astype(np.uint32).tobytes() for x in np.split(h, np.cumsum(count)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column("class"), part.column("group"), part.column("size"), pa.array(made, pa.binary())], ["class", "group", "size", "shingles"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("text_sha256", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    found = texts.join(small_side(groups), "text_sha256").select("class", "group", "size", "text").mapInArrow(sets, "class long, group long, size long, shingles binary")
    one = found.groupBy("class", "group", "size").agg(F.any_value("shingles").alias("shingles"))
    keys = ["group", "x", "y"]
    sent = in_tiles(one, F.col("size"), "class", tile).repartition(*keys).sortWithinPartitions(*keys, "class").select(*keys, "class", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, keys):
            own = table.column("class").to_numpy()
            sets = [np.frombuffer(s, np.uint32) for s in table.column("shingles").to_pylist()]
            first = run_starts([table.column(c).to_numpy() for c in keys])
            i, j = forest(first, len(own), lambda p, q: np.array([alike(sets[m], sets[n], similarity) for m, n in zip(p, q)], bool))
            yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(own[j])], ["a", "b"])

    return sent.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, prints: DataFrame, text_col: str = "text", similarity: float = SIMILARITY,
                    candidate: float = CANDIDATE, tile: int = TILE, shingle: int = SHINGLE) -> DataFrame:
    """``prints`` (id, text_sha256, fingerprint, ... of ``docs``' texts, read several times) with ``component_id``:
    the smallest id reachable by texts of at least ``similarity``, its own included."""
    one = prints.select("id", F.unhex("text_sha256").alias("text_sha256"), F.unhex("fingerprint").alias("fingerprint")).groupBy("text_sha256").agg(F.any_value("fingerprint").alias("fingerprint"), F.min("id").alias("low"), F.count("*").alias("n"))
    classes = write_table(one.withColumn("class", F.monotonically_increasing_id()), "minhash-classes")
    links = write_table(band_links(classes.select("class", "fingerprint"), candidate), "minhash-candidates")
    grouped = connected_components(links, "minhash-groups").select(F.col("node").alias("class"), F.col("component").alias("group"))
    sizes = grouped.groupBy("group").agg(F.count("*").alias("size"))
    groups = write_table(grouped.join(sizes, "group").join(classes.select("class", "text_sha256"), "class"), "minhash-members")
    sure = write_table(verified_links(docs, text_col, groups, similarity, tile, shingle), "minhash-links")
    comp = connected_components(sure, "minhash").select(F.col("node").alias("class"), "component")
    tied = classes.select("class", "text_sha256", "low", "n").join(comp, "class", "left").selectExpr(
        "class", "text_sha256", "low", "n", "component IS NOT NULL AS linked", "coalesce(component, class) AS component")
    least = tied.groupBy("component").agg(F.min("low").alias("component_id"))
    keyed = tied.join(least, "component").select(F.lower(F.hex("text_sha256")).alias("text_sha256"), "n", "component_id", "linked")
    # a text on one row that links with nothing is its row's own component; only the others are looked up
    shared = write_table(keyed.filter("n > 1 OR linked").select("text_sha256", "n", F.col("component_id").alias("shared_id")), "minhash-keyed")
    return lookup(prints, shared, "text_sha256", "n", "left").withColumn("component_id", F.expr("IF(found, shared_id, id)")).drop("found", "shared_id")
