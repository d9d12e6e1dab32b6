"""Embedding whitening with Spark MLlib's distributed matrices.

Entries become whole numbers x = floor(64 * c) + 1000000. Rows are numbered without gaps, centred and
cut into a BlockMatrix; its transpose multiplied by itself is the scatter, whose eigenvectors are
found on the driver (dimensions squared numbers, whatever the rows). A second BlockMatrix product, by
the eigenvectors over the roots of their eigenvalues, projects the rows; a third is the scatter of the
results, from which the largest entry of their covariance minus the identity follows.

The scatter's grid has one block a pair of column blocks, so by default one task would read all rows:
the rows' blocks are dealt over groups (``numMidDimSplits``), whose products are added up afterwards.
Sums are exact whole numbers; a deviation beyond a long raises an error (ANSI mode) or gives null.

Rows whose vector is null, empty, or holds null or non-finite entries are left out. Vectors of different
lengths have no covariance: each length is whitened by itself. Components without variance
(eigenvalue at most 1e-12 of the largest, or zero) can't be scaled and are left out, so a table of one
row, or of equal rows only, gives no rows, as an empty one does. Equal vectors get equal results;
repeated and null ids are rows as any other. Ties among eigenvalues: any orthonormal choice.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.operators.tables import write_table

#: Entries of a block, at most (512 kB of doubles), and columns of one.
BLOCK_ENTRIES, BLOCK_COLUMNS = 1 << 16, 256
#: Blocks of rows whose products one task adds up.
BLOCKS_A_TASK = 64
#: Longest vectors: the scatter of these takes 512 MB on the driver.
MOST_DIMENSIONS = 8192
NO_VARIANCE = 1e-12


def whole_entries(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): the rows whose vector has entries, none of them null or non-finite, as whole numbers."""
    v = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = v.filter(F.expr("size(v) > 0 AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('infinity'))"))
    return sound.select("id", F.expr("transform(v, c -> cast(floor(64 * c) AS bigint) + 1000000)").alias("x"))


def placed(rows: DataFrame, name: str) -> DataFrame:
    """A written table of ``rows`` with ``place``: the task that wrote a row and the row's number in it."""
    return write_table(rows.withColumn("place", F.monotonically_increasing_id()), name)


def numbered(rows: DataFrame) -> DataFrame:
    """A ``placed`` table with ``row``, the numbers of its rows from 0 without gaps: the number in its
    task plus the rows of the tasks before. Only one (task, rows) pair a task is sorted in one place."""
    task = F.shiftright("place", 33)
    counts = rows.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = counts.selectExpr("task", "sum(n) OVER (ORDER BY task ROWS UNBOUNDED PRECEDING) - n AS before")
    return (rows.withColumn("task", task).join(F.broadcast(before), "task")
            .withColumn("row", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)).drop("task", "before", "place"))


def block_matrix(rows: DataFrame, vector: str, n: int, dim: int) -> BlockMatrix:
    """Rows (row, ``vector``: array of doubles) as a matrix of ``n`` by ``dim``."""
    indexed = MLUtils.convertVectorColumnsFromML(rows.select(F.col("row").alias("index"), array_to_vector(F.col(vector)).alias("vector")), "vector")
    columns = min(dim, BLOCK_COLUMNS)
    return IndexedRowMatrix(indexed, n, dim).toBlockMatrix(max(1, BLOCK_ENTRIES // columns), columns)


def product(left: BlockMatrix, right: BlockMatrix, middle: int) -> BlockMatrix:
    """``left`` times ``right``, the sum over the inner blocks dealt over ``middle`` tasks a result block."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, middle)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def scatter(m: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times itself, on the driver (columns squared)."""
    blocks = -(-m.numRows() // m.rowsPerBlock)
    return product(m.transpose(), m, max(1, -(-blocks // BLOCKS_A_TASK))).toLocalMatrix().toArray()


def small_matrix(a: np.ndarray, spark, rows_per_block: int) -> BlockMatrix:
    """A driver's matrix as a BlockMatrix with blocks of ``rows_per_block`` rows, one column of blocks."""
    blocks = [((i, 0), DenseMatrix(len(part), a.shape[1], part.ravel(order="F")))
              for i, k in enumerate(range(0, len(a), rows_per_block)) for part in [a[k:k + rows_per_block]]]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, min(len(blocks), 16)), rows_per_block, a.shape[1], a.shape[0], a.shape[1])


def whiten_length(rows: DataFrame, n: int, dim: int, components: int) -> DataFrame:
    """The whitened rows of vectors of one length: ``rows`` (row, id, x), read several times."""
    spark = rows.sparkSession
    sums = rows.select(F.posexplode("x").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("s")).collect()   # one row a dimension
    s = np.zeros(dim, dtype=object)
    for r in sums:
        s[r["k"]] = r["s"]
    total = F.lit([int(v) for v in s])
    mean = F.lit([float(v) / n if abs(v) < 1 << 53 else v // n + (v % n) / n for v in s])
    centred = F.zip_with("x", mean, lambda x, m: x.cast("double") - m)
    m = block_matrix(rows.select("row", centred.alias("v")), "v", n, dim)
    values, vectors = np.linalg.eigh(scatter(m) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = values.sum()
    kept = int((values[:components] > NO_VARIANCE * max(values[0], 0)).sum())
    schema = "id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not kept:
        return spark.createDataFrame([], schema.format(rows.schema["id"].dataType.simpleString()))
    turn = vectors[:, :kept] / np.sqrt(values[:kept])
    projected = product(m, small_matrix(turn, spark, m.colsPerBlock), 1)
    done = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    done = MLUtils.convertVectorColumnsToML(done, "vector").select(F.col("index").alias("row"), vector_to_array("vector").alias("w"))
    done = write_table(done, "whitened")
    # the covariance of what comes out, its own mean taken off
    left = np.array([r["m"] for r in done.select(F.posexplode("w").alias("k", "w")).groupBy("k").agg(F.avg("w").alias("m")).orderBy("k").collect()])
    off = block_matrix(done.select("row", F.zip_with("w", F.lit(left.tolist()), lambda w, m: w - m).alias("v")), "v", n, kept)
    error = float(np.abs(scatter(off) / n - np.eye(kept)).max())
    deviation = F.aggregate(F.zip_with("x", total, lambda x, t: (x * n - t).cast("decimal(19,0)")), F.lit(0).cast("decimal(38,0)"),
                            lambda a, d: (a + d * d).cast("decimal(38,0)"))
    explained = F.lit((values[:kept] / trace).tolist())
    return (rows.select("row", "id", deviation.cast("long").alias("deviation")).join(done, "row")
            .select("id", "deviation", F.posexplode("w").alias("k", "whitened"))
            .select("id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error")))


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, ``component`` (from 1, by falling eigenvalue, at most ``components``), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error`` for every sound row and component."""
    sound = placed(whole_entries(vectors, id_col, vector_col), "whole-entries")
    out = sound.sparkSession.createDataFrame([], f"id {sound.schema['id'].dataType.simpleString()}, component int, n long, deviation long, "
                                                 "whitened double, explained double, identity_error double")
    lengths = sound.groupBy(F.size("x").alias("dim")).count().orderBy("dim").collect()   # one row a length
    for r in lengths:
        if r["dim"] > MOST_DIMENSIONS:
            raise ValueError(f"vectors of {r['dim']} dimensions; the limit is {MOST_DIMENSIONS}")
        own = sound if len(lengths) == 1 else placed(sound.filter(F.size("x") == r["dim"]).drop("place"), "entries-of-a-length")
        out = out.unionByName(whiten_length(numbered(own), r["count"], r["dim"], components))
    return out.withColumnRenamed("id", id_col)
