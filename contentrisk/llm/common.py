"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.operators.tables import write_table

#: A side of a join is broadcast only if a count shows at most this many (narrow) rows.
BROADCAST_ROWS = 200_000
#: A key is hot if it holds over 1/HOT_PARTS of all rows, so there are at most HOT_PARTS hot keys.
HOT_PARTS = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clear_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rename the columns that have a result column's name: ``score`` becomes ``score_in``."""
    taken, names = {c.lower() for c in df.columns}, {n.lower() for n in names}
    for c in df.columns:
        if c.lower() in names:
            new = f"{c}_in"
            while new.lower() in taken | names:
                new += "_in"
            taken.add(new.lower())
            df = df.withColumnRenamed(c, new)
    return df


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The (written) narrow table with a broadcast hint if it has few rows, else as it is.

    Beyond the bound Spark joins by a shuffle, with AQE's skew handling.
    """
    return F.broadcast(df) if df.count() <= rows else df


def dealt(rows: DataFrame, keys: list[str], member: str, tile: int) -> DataFrame:
    """``rows`` (a written table) with ``x`` and ``y``, for comparing the rows of equal ``keys`` in pieces: a
    group of more than ``tile`` rows is cut in tiles by its ``member``, and a row comes with each pair of tiles."""
    large = rows.groupBy(*keys).agg(F.count("*").alias("size")).filter(F.col("size") > tile)
    large = write_table(large, "large-groups")
    if large.isEmpty():
        return rows.withColumns({"x": F.lit(0), "y": F.lit(0)})
    return in_tiles(rows.join(small_side(large), keys, "left"), F.coalesce("size", F.lit(1)), member, tile)


def in_tiles(rows: DataFrame, size, member: str, tile: int) -> DataFrame:
    """As ``dealt``, where each row knows the ``size`` of its group."""
    n = F.ceil(size / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64(member), F.col("tiles")).cast("int")
    pairs = F.expr("explode(transform(sequence(0, tiles - 1), u -> struct(least(tile, u) AS x, greatest(tile, u) AS y)))")
    return rows.withColumn("tiles", n).withColumn("tile", own).withColumn("p", pairs).select("*", "p.x", "p.y").drop("tiles", "tile", "p", "size")


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal values begin in sorted columns."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]))


def lookup(rows: DataFrame, keyed: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``keyed`` (one row a key, ``count`` rows of ``rows`` each) on ``key``. With
    ``how="left"`` rows without one stay, and ``found`` tells them.

    Keys with over 1/HOT_PARTS of the rows, at most HOT_PARTS of them, are joined by a
    broadcast; the others by a shuffle in which no key holds more than that share. ``rows``
    and ``keyed`` are read twice: pass written tables.
    """
    total = keyed.agg(F.sum(count)).first()[0] or 0
    hot = keyed.filter(F.col(count) * HOT_PARTS > F.lit(total)).drop(count)
    cold = keyed.filter(F.col(count) * HOT_PARTS <= F.lit(total)).drop(count)
    a = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    if how == "inner":
        return a.unionByName(rest.join(cold, key))
    b = rest.join(small_side(cold.withColumn("found", F.lit(True))), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))
    return a.withColumn("found", F.lit(True)).unionByName(b)


def popcount(c):
    return F.bit_count(c)


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected graph; component: the smallest node reachable.

    ``edges`` has long columns ``a`` and ``b``; nodes without edges don't appear. Alternating
    large-star and small-star rounds, each a few joins on narrow rows; every round is written
    to the shared folder, so that a lost executor costs one round, and counted as it is written. The neighbours of
    a node are never gathered: a round takes each node's minimum by an aggregate and joins it back.
    """
    spark = edges.sparkSession

    def canonical(df):
        return (df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct())

    def written(df, k):
        """The edges as a table, their number and a sum of their hashes."""
        seen = Observation()
        out = write_table(canonical(df).observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")), f"{name}-cc{k}")
        return out, (seen.get["n"], seen.get["hashes"])

    e, now = written(edges, 0)
    if not now[0]:
        return spark.createDataFrame([], "node long, component long")
    for k in range(1, max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        large = canonical(large)
        # small star: of each node's smaller neighbours the least is the centre of the others and of the node
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        last = now
        e, now = written(small, k)
        if now == last:
            break
    else:
        raise RuntimeError("components did not settle")
    star = e.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("node"), "component")
    centres = e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return write_table(star.unionByName(centres), f"{name}-components")


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as tables in which every run of equal ``keys`` stands whole; the last may be empty."""
    rest, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols]))
        if rest and any(c[0] != v for c, v in zip(cols, last)):
            yield pa.Table.from_batches(rest)
            rest = []
        last = [c[-1] for c in cols]
        if not len(change):
            rest.append(batch)
            continue
        cut = int(change[-1]) + 1
        yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
        rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest)


def forest(first: np.ndarray, n: int, near: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) for which ``near`` holds that connect each bucket's members as all such pairs do: in a
    component of k members k - 1, at any size.

    Buckets lie one after the other over 0..n - 1 and begin at ``first``. All of them are searched
    breadth-first side by side, a member of each at a step, which is compared with those that none
    has reached yet: what is near an earlier member is not compared again.
    """
    ends = np.concatenate([first[1:], [n]]).astype(np.int64)
    queue = np.arange(n)                      # a bucket's members in the order they are reached
    head, reached = first.astype(np.int64).copy(), first.astype(np.int64) + 1
    left = np.setdiff1d(np.arange(n), first)  # not reached yet
    bucket = np.repeat(np.arange(len(first)), ends - first)
    out_i, out_j = [], []
    while len(left):
        own = bucket[left]
        active = own[np.concatenate([[True], own[1:] != own[:-1]])]
        # nothing waits: the first member left begins a component
        idle = active[head[active] == reached[active]]
        if len(idle):
            at = np.searchsorted(own, idle)
            queue[reached[idle]] = left[at]
            reached[idle] += 1
            left, own = np.delete(left, at), np.delete(own, at)
        seed = queue[head[own]]
        head[active] += 1
        hit = np.flatnonzero(near(seed, left)) if len(left) else np.zeros(0, np.int64)
        if len(hit):
            out_i.append(seed[hit])
            out_j.append(left[hit])
            b = own[hit]
            start = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            size = np.diff(np.concatenate([start, [len(b)]]))
            queue[reached[b] + np.arange(len(b)) - np.repeat(start, size)] = left[hit]
            reached[b[start]] += size
            left = np.delete(left, hit)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j])


def find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def union(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining the pairs (i, j): the smaller root of each pair, until nothing changes."""
    parent = find(parent)
    while True:
        a, b = parent[i], parent[j]
        if (a == b).all():
            return parent
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(parent, hi, lo)
        parent = find(parent)


def text_array(column: pa.Array) -> pa.Array:
    """Strings with nulls as empty texts."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows of about ``max_bytes`` of text (a longer text is a run of its own)."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(size, done + max_bytes, "right")))
        yield batch.slice(start, end - start)
        start, done = end, int(size[end - 1])


def raw(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of a string array without nulls, and where each text begins (and the end)."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or bounds[0] == bounds[-1]:
        return b"", np.zeros(len(texts) + 1, np.int64)
    return texts.buffers()[2][int(bounds[0]):int(bounds[-1])].to_pybytes(), bounds - bounds[0]


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """Texts with every byte replaced by ``table`` (ASCII by ASCII)."""
    data, bounds = raw(texts)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data.translate(table)))


def split_words(texts: pa.Array, pattern: str = " ") -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Texts cut at each space: row starts in the words, each word's number, the distinct words,
    and each word's length in characters. Cutting, hashing and numbering run inside Arrow."""
    cut = pc.split_pattern(texts, pattern)
    words = cut.flatten()
    starts = np.asarray(cut.offsets, dtype=np.int64)
    starts = starts - starts[0]
    coded = words.dictionary_encode()
    return starts, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, pc.utf8_length(words).to_numpy(zero_copy_only=False)


class KnownWords:
    """What a function makes of words, kept for words that came more than once in a batch, up to
    ``most`` of them. ``fn`` maps a list of words to (values, number of values of each word)."""

    def __init__(self, fn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 250_000):
        self.fn, self.most = fn, most
        self.words, self.values, self.ptr = pa.array([], pa.string()), None, np.zeros(1, np.int64)

    def __call__(self, words: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values of the distinct ``words`` that came ``times`` each: all values, and where each
        word's begin and how many there are."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        fresh = words.take(pa.array(new))
        values, size = self.fn(fresh.to_pylist())
        ends = np.cumsum(size)
        kept = self.values if self.values is not None else values[:0]
        begin, count = self.ptr[np.maximum(at, 0)], np.zeros(len(at), np.int64)
        old = at >= 0
        count[old] = self.ptr[at[old] + 1] - self.ptr[at[old]]
        begin[new], count[new] = ends - size + len(kept), size
        out = np.concatenate([kept, values])
        keep = np.flatnonzero(times[new] > 1)[:max(0, self.most - len(self.words))]
        if len(keep):
            more = gather(values, (ends - size)[keep], size[keep])
            self.words = pa.concat_arrays([self.words, fresh.take(pa.array(keep))])
            self.values = np.concatenate([kept, more])
            self.ptr = np.concatenate([self.ptr, self.ptr[-1] + np.cumsum(size[keep])])
        return out, begin, count


def gather(values: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that start at ``begin``, one after the other."""
    ends = np.cumsum(count)
    return values[np.repeat(begin - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]


def map_texts(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable]) -> DataFrame:
    """``df`` with the columns that a function of its texts adds, in Arrow batches.

    ``make`` is called once a task and returns fn(texts: pa.Array) -> list of arrays, one a
    field. Input columns of a result's name are renamed (``clear_names``), the text column too;
    ``text`` is null-safe.
    """
    names = [f.name for f in fields]
    place = [c.lower() for c in df.columns].index(text.lower())
    df = clear_names(df, names)
    text = df.columns[place]
    schema = T.StructType(df.schema.fields + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch, text):
                made = fn(text_array(part.column(text)))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *names])

    return df.mapInArrow(run, schema)


def labelled_ids(labels: DataFrame, label: str, id_col: str) -> DataFrame:
    """(id, lo): the ids with one label; those with both labels, or none, are left out."""
    return (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col)
            .agg(F.min(label).alias("lo"), F.max(label).alias("hi")).filter("lo = hi").drop("hi"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, most: tuple[int, int]) -> DataFrame:
    """(text, label) of at most ``most`` documents with label 0 and with label 1.

    The first by a hash of the id, so the same rows at every run; ids with both labels, or
    none, are left out. The sampled ids (sum(most) at most) are broadcast to the documents. Of an
    id on several rows, one text comes back, the first by a hash: each task keeps one an id.
    """
    one = labelled_ids(labels, label, id_col)
    picked = None
    for v in (0, 1):
        part = one.filter(F.col("lo") == v).orderBy(F.xxhash64(id_col), id_col).limit(most[v])
        picked = part if picked is None else picked.unionByName(part)
    picked = picked.select(F.col(id_col).alias("__id"), F.col("lo").cast("int").alias("label"))
    return (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
            .join(F.broadcast(picked), "__id").groupBy("__id", "label")
            .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")).select("one.text", "label"))
