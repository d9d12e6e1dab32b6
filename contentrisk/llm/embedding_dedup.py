"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are made unit length and turned so that their dimensions come in order of variance over all
vectors (a rotation: cosines stay). They are cut into tiles; every pair of tiles is compared by one
task, tile by tile a matrix product over the leading dimensions. What the other dimensions can add
to a product is at most the product of the two suffix norms (Cauchy-Schwarz): a pair is dropped as
soon as leading part plus that bound is below the threshold, in steps of more and more dimensions,
and only survivors' products are completed. That is exact, and quadratic in the number of vectors,
but for dense arithmetic on a quarter of the dimensions for nearly all pairs.

Only counts of links and enough links to connect what they connect leave a task, never all pairs of
a group. Vectors of different lengths don't link; each length that two rows or more have is compared by itself,
one after the other. Vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing: a
row of their own. Rows are told apart by their place, so
repeated rows (and repeated or null ids) are rows that link with each other. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.llm.common import connected_components, union
from contentrisk.operators.tables import write_table

TILE = 4096
#: Rows of a tile compared at a time: a product of this by TILE doubles.
STRIP = 512
#: Leading dimensions, as shares of all, after which pairs are dropped.
STEPS = (0.25, 0.5, 1.0)
LINKS = "a long, b long, n long"


def unit(v) -> np.ndarray | None:
    if v is None or not len(v) or any(x is None for x in v):
        return None
    x = np.asarray(v, dtype=np.float64)
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top   # no overflow, no underflow
    return x / np.sqrt(x @ x)


def unit_rows(vectors: DataFrame) -> DataFrame:
    """(row, id, dim, v): unit vectors as bytes of doubles; null where a vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [unit(v) for v in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), pa.array([0 if u is None else len(u) for u in made], pa.int32()),
                                              pa.array([None if u is None else u.tobytes() for u in made], pa.binary())], ["row", "id", "dim", "v"])

    return vectors.mapInArrow(run, "row long, id long, dim int, v binary")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def rotation(units: DataFrame, dim: int) -> np.ndarray:
    """The principal directions of all vectors, by falling variance. Tasks return sums of products:
    dim * dim numbers each, added up before they come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("v"), dim)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["k", "s"])

    got = units.select("v").mapInArrow(run, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    c = np.zeros(dim * dim)
    for r in got:
        c[r["k"]] = r["s"]
    values, directions = np.linalg.eigh(c.reshape(dim, dim))
    return directions[:, np.argsort(-values, kind="stable")]


def compare(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with a[i] . b[j] >= threshold, by strips; i < j if both are the same tile."""
    dim = a.shape[1]
    cuts = sorted({max(1, int(round(dim * s))) for s in STEPS})
    suffix = [(np.sqrt((a[:, c:] ** 2).sum(1)), np.sqrt((b[:, c:] ** 2).sum(1))) for c in cuts]
    slack = 1e-9   # rounding never drops a pair; the whole product decides
    for k in range(0, len(a), STRIP):
        x, c, (sa, sb) = a[k:k + STRIP], cuts[0], suffix[0]
        first = k if same else 0   # in the same tile, only later ones
        bound = x[:, :c] @ b[first:, :c].T
        bound += np.multiply.outer(sa[k:k + STRIP], sb[first:])
        at = np.flatnonzero(bound.ravel() >= threshold - slack)
        i, j = at // bound.shape[1] + k, at % bound.shape[1] + first
        if same:
            i, j = i[i < j], j[i < j]
        del bound
        for lo in range(0, len(i), 1 << 18):   # survivors, in bounded runs
            p, q = i[lo:lo + (1 << 18)], j[lo:lo + (1 << 18)]
            dot = np.einsum("nd,nd->n", a[p, :c], b[q, :c])
            done = c
            for cut, (ta, tb) in zip(cuts[1:], suffix[1:]):
                dot = dot + np.einsum("nd,nd->n", a[p, done:cut], b[q, done:cut])
                keep = dot + ta[p] * tb[q] >= threshold - slack
                p, q, dot, done = p[keep], q[keep], dot[keep], cut
            keep = dot >= threshold
            if keep.any():
                yield p[keep], q[keep]


def tile_links(units: DataFrame, turn: np.ndarray, dim: int, threshold: float, tile: int) -> DataFrame:
    """(a, b, n): with b null, n links of row a; else a link, of enough to connect what all links do."""
    n_tiles = max(1, -(-units.count() // tile))
    dealt = units.withColumn("tile", F.pmod(F.xxhash64("row"), F.lit(n_tiles)).cast("int"))
    # tile t meets t..n-1 as the first of a pair, and 0..t-1 as the second
    pairs = F.expr(f"transform(sequence(0, {n_tiles - 1}), u -> struct(least(tile, u) AS x, greatest(tile, u) AS y))")
    sent = dealt.select("row", "v", "tile", F.explode(pairs).alias("p")).select("row", "v", "tile", "p.x", "p.y")

    def run(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        tiles, rows = table.column("tile").to_numpy(), table.column("row").to_numpy()
        v = matrix(table.column("v"), dim) @ turn
        ra, rb = rows[tiles == x], rows[tiles == y]
        a, b = v[tiles == x], v[tiles == y]
        same = x == y
        # nodes: rows of a, then of b
        shift = 0 if same else len(ra)
        every = ra if same else np.concatenate([ra, rb])
        count, parent = np.zeros(len(every), np.int64), np.arange(len(every))
        for i, j in compare(a, b, threshold, same):
            count += np.bincount(i, minlength=len(every)) + np.bincount(j + shift, minlength=len(every))
            parent = union(parent, i, j + shift)
        linked, tied = np.flatnonzero(count), np.flatnonzero(parent != np.arange(len(every)))
        return pa.table({"a": pa.array(np.concatenate([every[linked], every[tied]])),
                         "b": pa.concat_arrays([pa.nulls(len(linked), pa.int64()), pa.array(every[parent[tied]])]),
                         "n": pa.array(np.concatenate([count[linked], np.zeros(len(tied), np.int64)]))})

    return sent.groupBy("x", "y").applyInArrow(run, LINKS)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", tile: int = TILE) -> DataFrame:
    """``id_col``, ``n_links`` (other rows linked directly), ``component_id`` (the smallest id reachable
    by links, its own included) and ``kept`` (the id is the component's) for every row."""
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    units = write_table(unit_rows(rows), "embed-units")
    found = units.sparkSession.createDataFrame([], LINKS)
    for r in units.filter("dim > 0").groupBy("dim").count().filter("count > 1").orderBy("dim").collect():
        usable = units.filter(F.col("dim") == r["dim"]).select("row", "v")
        found = found.unionByName(tile_links(usable, rotation(usable, r["dim"]), r["dim"], threshold, tile))
    found = write_table(found, "embed-links")
    links = found.filter("b IS NULL").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n_links"))
    comp = connected_components(found.filter("b IS NOT NULL").select("a", "b"), "embed").withColumnsRenamed({"node": "row"})
    tagged = units.select("row", "id").join(comp, "row", "left").withColumn("component", F.coalesce("component", "row"))
    low = tagged.groupBy("component").agg(F.min("id").alias("component_id"))
    return (tagged.join(low, "component").join(links, "row", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")))
