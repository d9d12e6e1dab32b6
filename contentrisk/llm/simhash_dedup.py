"""SimHash near-duplicates by pigeonring filtering.

A fingerprint's 64 bits are cut into a ring of ``SEGMENTS`` segments. If two fingerprints differ
in at most r bits, some segment starts a chain all of whose prefixes keep within budget: the first
l segments differ in at most l * r / SEGMENTS bits together (the pigeonring principle; the plain
pigeonhole is l = 1). So fingerprints are dealt by the segments of a chain in which at most one bit
may differ: its exact part, and all but one of the segments behind that. Within such a bucket the
rest of the chain condition and then the whole Hamming distance decide.

Documents of one fingerprint are one class, held once. In a bucket of any size a breadth-first search
gives a forest of links, one fewer than a component has members, and a link comes from one bucket only.
So no group's pairs are emitted, and none is missed: components are those of all links. Null and empty texts have no words and the fingerprint zero, linked like any
other. Repeated rows share a fingerprint. Rows with a null id take part in grouping, but give no
component id of their own (a component of such rows only has a null id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.llm.common import connected_components, forest, lookup, map_texts, small_side, whole_runs
from contentrisk.operators.tables import free_name, row_hash, write_table

SEED = 42
SEGMENTS, WIDTH = 16, 4
#: Masks of one start, at most.
MASKS = SEGMENTS + 1


def fingerprint(text: str, shingle: int) -> int:
    """Majority of the bits of the XXH64 of all shingles of ``shingle`` words (ASCII case folded)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII only
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    if len(words) < shingle:
        h = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        f = xxhash.xxh64_intdigest
        h = [f(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:])]
    # in runs, so that a very long text takes bounded memory
    votes = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = np.array(h[i:i + (1 << 16)], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(h), bitorder="little").tobytes(), "little")


def add_fingerprints(docs: DataFrame, text_col: str, shingle: int, name: str) -> DataFrame:
    """``docs`` with the signed 64-bit column ``name``."""

    def fn(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64).view(np.int64))]

    return map_texts(docs, text_col, [T.StructField(name, T.LongType())], lambda: fn)


def chain_length(distance: int, allowed: int) -> int:
    """Longest chain that may differ in at most ``allowed`` bits: l * distance / SEGMENTS < allowed + 1."""
    if not distance:
        return SEGMENTS
    return min(SEGMENTS, -(-(allowed + 1) * SEGMENTS // distance) - 1)


def masks(distance: int) -> list[tuple[int, int]]:
    """(number, bits) of the masks under which fingerprints are looked up: for each start of a chain its
    exact segments and all but one of those behind them that may hold the one differing bit."""
    exact, one = chain_length(distance, 0), chain_length(distance, 1)
    if not exact:
        raise ValueError(f"at most {SEGMENTS - 1} bits")
    return [(s * MASKS + j + 1, sum(0xF << (WIDTH * ((s + k) % SEGMENTS)) for k in range(one) if k != j))
            for s in range(SEGMENTS) for j in (range(exact, one) or [-1])]


def bucket_keys(fp: str, distance: int):
    """The keys under which a fingerprint is looked up, as SQL: masked, with the number of the mask."""
    keys = [f"struct(cast({n} as int) as mask, {fp} & cast({m - (1 << 64) if m >> 63 else m} as bigint) as bits)" for n, m in masks(distance)]
    return F.explode(F.expr(f"array({', '.join(keys)})"))


def chain_ok(diff: np.ndarray, start: int, distance: int) -> np.ndarray:
    """Does the chain from ``start`` keep within budget at every length?"""
    ok, total = np.ones(diff.shape, bool), np.zeros(diff.shape, np.uint8)
    for k in range(SEGMENTS):
        seg = (diff >> np.uint64(WIDTH * ((start + k) % SEGMENTS))) & np.uint64(0xF)
        total = total + np.bitwise_count(seg)
        ok &= total * SEGMENTS <= (k + 1) * distance
    return ok


def linked(diff: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(diff) <= distance


def first_mask(diff: np.ndarray, distance: int) -> np.ndarray:
    """The first mask under which two fingerprints with this difference meet and pass the chain test."""
    out = np.full(diff.shape, -1)
    ok = [chain_ok(diff, s, distance) for s in range(SEGMENTS)]
    for n, m in masks(distance):
        out[(out < 0) & ((diff & np.uint64(m)) == 0) & ok[n // MASKS]] = n
    return out


def links_of(mask: np.ndarray, bits: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of links over each bucket of rows sorted by (mask, bits), of any size.

    A link is left to the first bucket in which its ends meet: there the two are connected (by links of
    that bucket, or again of earlier ones), so none is given twice.
    """
    first = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])])) if len(fp) else np.zeros(0, np.int64)

    def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        diff = fp[i] ^ fp[j]
        ok = linked(diff, distance)
        at = np.flatnonzero(ok)
        start = mask[i[at]] // MASKS
        for s in np.unique(start):
            own = at[start == s]
            ok[own] = chain_ok(diff[own], int(s), distance)
        return ok

    i, j = forest(first, len(fp), near)
    own = first_mask(fp[i] ^ fp[j], distance) == mask[i]
    return fp[i[own]], fp[j[own]]


def candidate_links(fps: DataFrame, distance: int) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that connect them as all links do."""
    keyed = fps.select("fp", bucket_keys("fp", distance).alias("key")).select("key.mask", "key.bits", "fp")
    keyed = keyed.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["mask", "bits"]):
            mask, bits, fp = (table.column(c).to_numpy() for c in ("mask", "bits", "fp"))
            a, b = links_of(mask, bits, fp.view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return keyed.mapInArrow(run, "a long, b long")


def grouped(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id, group) of every row; ``group`` tells components apart whose smallest id is the same."""
    rows = add_fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", shingle, "fp").select("id", "fp")
    rows = write_table(rows, "simhash-rows")
    # one row a fingerprint; copies count, but are compared once
    classes = write_table(rows.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("n")), "simhash-classes")
    links = write_table(candidate_links(classes.select("fp"), distance), "simhash-links")
    comp = connected_components(links, "simhash")
    # the smallest id of a component's classes
    tied = classes.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left")
    low = tied.filter("component IS NOT NULL").groupBy("component").agg(F.min("low").alias("least"))
    keyed = (tied.join(low, "component", "left")
             .select("fp", "n", F.coalesce("least", "low").alias("component_id"), F.coalesce("component", "fp").alias("group")))
    return lookup(rows, write_table(keyed, "simhash-keyed"), "fp", "n")


def near_duplicates(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` (the smallest id reachable by
    links, the row's own included) for every row of ``docs``."""
    return (grouped(docs, shingle, distance, id_col, text_col)
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with its smallest id (of several rows with that
    id, the first by a hash of the row). An id may stand on different texts, which are judged each by
    its own. Rows with a null id can't be named, and stay."""
    found = grouped(docs, shingle, distance, id_col, text_col).filter("id IS NOT NULL")
    # narrow: ids that go, and ids that come several times and stay; texts are shuffled only if these are many
    ids = (found.groupBy("id").agg(F.count_if(F.expr("id <> component_id")).alias("goes"), F.count_if(F.expr("id = component_id")).alias("stays"))
           .filter("goes > 0 OR stays > 1"))
    named_id = free_name(docs, "id")
    ids = write_table(ids.withColumnRenamed("id", named_id), "simhash-ids")
    own = F.col(f"`{id_col}`") == F.col(named_id)
    rows = docs.join(small_side(ids.filter("stays = 0").select(named_id)), own, "left_anti")
    several = ids.filter("stays > 0").select(named_id)
    if several.isEmpty():
        return rows
    several = small_side(several)
    alone = rows.join(several, own, "left_anti")
    repeated = (rows.join(several, own, "left_semi")
                .select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_hash(docs).alias("hash"),
                        F.col(f"`{id_col}`").alias("own"), F.col(f"`{text_col}`").alias("text")))
    named = found.filter("id = component_id").join(several, F.col("id") == F.col(named_id), "left_semi").select(F.col("id").alias("own"), "fp", "group").distinct()
    first = (add_fingerprints(repeated, "text", shingle, "fp").join(named, ["own", "fp"])
             .groupBy("own", "group").agg(F.min_by("row", "hash").alias("row")).select("row.*"))
    return alone.unionByName(first)
