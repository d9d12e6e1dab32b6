"""Partitioning helpers for CPU-heavy, row-independent stages.

Dictionary matching and text extraction cost CPU per byte but need no
co-location. When an input comes in fewer splits than the cluster has cores (one
large file, one row group), its rows can be spread so that every core works. That
is the caller's choice: nothing here looks at a plan with shuffles in it, which
would run them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_for_cpu(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows dealt over so many partitions; as they are without a number, and in streams."""
    if partitions is None or df.isStreaming:
        return df
    # Spread on the row's position, not on a data key: copies sharing an id or a
    # hash would all hash to one partition. The position is fixed by the input
    # split and row order, so a retried task sends every row to the same place.
    # Explicit count: AQE keeps it (a count-based repartition is never coalesced).
    pos = "__cr_pos"
    return df.withColumn(pos, F.monotonically_increasing_id()).repartition(partitions, pos).drop(pos)


def cores_beyond_splits(scan: DataFrame) -> int | None:
    """The number of cores if a file scan (with projections only) has fewer splits, else None."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return cores if scan.rdd.getNumPartitions() < cores else None
