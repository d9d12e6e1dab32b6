"""Table materialisation and merges (insert-only and upsert) on plain Parquet.

``write_table`` is the lineage cut used between the expensive enrichment and
the cheap analytics: the enriched rows are written once to a folder under the
shared ``spark.checkpoint.dir`` and read back, so downstream filters reach a
Parquet scan (pushdown, pruning) instead of re-running dictionary matching,
and a lost executor re-reads files instead of recomputing the whole lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.session import scratch_path


#: Partition columns of the raw and enriched tables that hold text.
STRING_PARTITIONS = ("source", "threat_severity", "stream", "attempt")


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                path: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    if partition_by:
        df = rebalance_for_write(df, partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # the schema is known: to infer it again takes a listing and a job of its own, also from the driver's memory
    return read_table(spark, path) if partition_by else spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A written table, with partition values as the strings they were written as ('001' is not 1).

    With ``schema`` its columns are read as declared; without, as written.
    """
    if schema is None:
        found = spark.read.parquet(path).schema
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in STRING_PARTITIONS else f for f in found.fields])
    return spark.read.schema(schema).parquet(path)


def rebalance_for_write(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Group rows by the output partition before a partitioned write.

    Without it every task writes one file per partition value it meets (files =
    tasks x values). The REBALANCE hint shuffles by the partition columns and lets
    AQE coalesce small partitions and split skewed ones (a source holding a third
    of all rows is written by many tasks, not one).
    """
    return df.hint("rebalance", *partition_by)


def write_clustered(df: DataFrame, path: str, by: str, mode: str = "append") -> DataFrame:
    """Write rows so that near values of ``by`` stand together: files, and the row groups in them, hold ranges of
    it, so a scan with a filter on ``by`` skips the others by their statistics.

    Range bounds are sampled, so a hot day is dealt over many files; rows of one value, of any number, are
    told apart by their hash.
    """
    tie = free_name(df, "tie")
    keyed = df.withColumn(tie, row_hash(df))
    keyed.repartitionByRange(by, tie).sortWithinPartitions(by, tie).drop(tie).write.mode(mode).parquet(path)
    return read_table(df.sparkSession, path)


Order = list[tuple[str, bool]]   # (column, ascending)


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType) or isinstance(t, T.ArrayType) and _has_map(t.elementType)


def without_maps(c: Column, t: T.DataType) -> Column:
    """A value with its maps, at any depth, as arrays of entries in order, which can be hashed and compared."""
    if not _has_map(t):
        return c
    if isinstance(t, T.MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            without_maps(e["key"], t.keyType).alias("key"), without_maps(e["value"], t.valueType).alias("value"))))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda e: without_maps(e, t.elementType))
    return F.when(c.isNotNull(), F.struct(*[without_maps(c.getField(f.name), f.dataType).alias(f"f{k}") for k, f in enumerate(t.fields)]))


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row: the last, deterministic tie-break."""
    return F.xxhash64(*[without_maps(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])


def dedupe_latest(df: DataFrame, key: str, order: Order | None = None, within: str | None = None, tie: str | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (latest-wins when ordered by time descending).

    Ordered by narrow columns only, and the rows are carried once. ``rn = 1`` lets Spark
    keep one row per key and task before the shuffle (WindowGroupLimit), so a key with a
    huge group of copies (a file replayed many times) never lands whole on one task.
    Nulls come last where the order is descending; rows with a null key are one group.

    ``within``: a column, made of the key, by which the rows are dealt already, so that they needn't be shuffled
    again. ``tie``: the column that holds ``row_hash``, if it was made before. Both are dropped.
    """
    by = [F.col(c).asc() if ascending else F.col(c).desc() for c, ascending in order or []]
    if tie is None:
        tie = free_name(df, "row_hash")
        df = df.withColumn(tie, row_hash(df.drop(within) if within else df))
    rn = free_name(df, "rn")
    first = F.row_number().over(Window.partitionBy(*([within] if within else []), key).orderBy(*by, tie))
    return df.withColumn(rn, first).where(F.col(rn) == 1).drop(rn, tie, *([within] if within else []))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def merge_insert_only(target: DataFrame, source: DataFrame, key: str,
                      order: Order | None = None) -> DataFrame:
    """Rows of ``source`` whose key is new to ``target`` (one per key), appended to ``target``.

    The MERGE ... WHEN NOT MATCHED INSERT of a table format, as a left-anti join on
    the key (AQE picks broadcast or sort-merge from runtime sizes).
    """
    src = dedupe_latest(source, key, order)
    new_rows = src.join(target.select(key), on=key, how="left_anti")
    return target.unionByName(new_rows.select(*target.columns))


def new_rows_only(target: DataFrame, source: DataFrame, key: str,
                  order: Order | None = None) -> DataFrame:
    """Just the rows an insert-only merge would append (what an append job writes)."""
    src = dedupe_latest(source, key, order)
    return src.join(target.select(key), on=key, how="left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, key: str,
                 order: Order) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE ALL WHEN NOT MATCHED INSERT ALL, as a DataFrame.

    Source rows are first reduced to one per key (latest by ``order``); target rows
    whose key appears in the source are replaced. The target needs the source's keys
    alone (a hash aggregate of one column), not its reduced rows a second time.
    """
    src = dedupe_latest(source, key, order)
    kept = target.join(source.select(key).distinct(), on=key, how="left_anti")
    return kept.unionByName(src.select(*target.columns))
