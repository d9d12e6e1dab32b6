"""Insert-only loads that don't read a table's keys: a fingerprint filter and a key index beside the table.

Beside a raw table (in ``<table>_keys``, outside the folder that streams watch) three small tables are kept:

* ``filter/array=<k>/`` (word, bits): an array of 2^k 64-bit words. A key's hash chooses a word and three bits in
  it, so a test is one equi join on the word. Loads add rows; rows of a word are combined by ``bit_or``.
* ``keys/bucket=<b>/``: the keys themselves, by bucket of the hash.
* ``done/`` (file, keys, array): the table's files whose keys are noted, written last.

A load first notes the keys of files that no load has noted (those of the load before, or of one that died:
the table's files are what counts, so nothing has to be undone). Then it tests its own keys. Nearly all new keys fail
the filter and are inserted without another look; the others, replayed ones and about one new key in 600, are checked
exactly against the key index, of which only their buckets are read. An array that comes to hold more than KEYS_A_WORD
keys a word is made anew from the key index, twice as long or more, so a key is noted about twice in all.

The filter is of the whole table: a key stands for itself, whatever partition its row is in.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.operators.tables import write_table

#: Keys of a filter word, on average at most: with three bits each of 64, 1 of 600 other keys passes.
KEYS_A_WORD = 3
#: The least array: 2 ** 10 words.
LEAST_ARRAY = 10
BUCKETS = 64

FILTER = "word long, bits long, array int"
KEYS = "key string, bucket int"
DONE = "file string, keys long, array int"


def beside(table_path: str, name: str) -> str:
    return f"{table_path.rstrip('/')}_keys/{name}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def word_of(h: Column, array: int) -> Column:
    return h.bitwiseAND(F.lit((1 << array) - 1))


def bits_of(h: str) -> Column:
    """Three of a word's 64 bits, by another hash of the hash."""
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({h}), {k}) & 63 AS int))" for k in (0, 20, 40)))


def _bits(keys: DataFrame, array: int) -> DataFrame:
    """(word, bits) of ``keys`` (h), one row a word."""
    return keys.select(word_of(F.col("h"), array).alias("word"), bits_of("h").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def current(spark: SparkSession, table_path: str) -> tuple[int, int, set[str]]:
    """The array in use, how many keys were noted, and of which files: a row a file, as in the table's listing."""
    rows = _read(spark, beside(table_path, "done"), DONE).collect()
    return max((r["array"] for r in rows), default=LEAST_ARRAY), sum(r["keys"] for r in rows), {r["file"] for r in rows}


def note_files(spark: SparkSession, table: DataFrame, table_path: str, key: str) -> int:
    """Note the keys of the table's files that aren't noted yet; the array in use."""
    array, known, done = current(spark, table_path)
    new = sorted(set(table.inputFiles()) - done)
    if not new:
        return array
    own = spark.read.schema(f"{key} string").parquet(*new).select(F.col(key).alias("key"), F.xxhash64(key).alias("h"))
    n = own.count()
    needed = max(LEAST_ARRAY, (max(1, (known + n)) // KEYS_A_WORD).bit_length())
    keyed = own.select("key", F.pmod("h", F.lit(BUCKETS)).cast("int").alias("bucket"))
    keyed.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(beside(table_path, "keys"))
    if needed > array or not done:
        array = max(needed, array)
        every = _read(spark, beside(table_path, "keys"), KEYS).select(F.xxhash64("key").alias("h"))
        _bits(every, array).write.mode("overwrite").parquet(beside(table_path, f"filter/array={array}"))
    else:
        _bits(own, array).write.mode("append").parquet(beside(table_path, f"filter/array={array}"))
    rows = [(f, n if k == 0 else 0, array) for k, f in enumerate(new)]
    spark.createDataFrame(rows, DONE).coalesce(1).write.mode("append").parquet(beside(table_path, "done"))
    return array


def known_keys(spark: SparkSession, table: DataFrame, table_path: str, keys: DataFrame, key: str) -> DataFrame:
    """Those of ``keys`` (distinct, column ``key``) that the table holds, in a written table."""
    array = note_files(spark, table, table_path, key)
    words = _read(spark, beside(table_path, "filter"), FILTER).filter(F.col("array") == array).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    own = keys.select(F.col(key).alias("key"), F.xxhash64(key).alias("h"))
    tested = own.withColumns({"word": word_of(F.col("h"), array), "own": bits_of("h")}).join(words, "word").filter("(bits & own) = own")
    possible = write_table(tested.select("key", F.pmod("h", F.lit(BUCKETS)).cast("int").alias("bucket")), "possible-keys")
    buckets = [r["bucket"] for r in possible.select("bucket").distinct().collect()]   # BUCKETS at most
    index = _read(spark, beside(table_path, "keys"), KEYS).filter(F.col("bucket").isin(buckets))
    return write_table(possible.join(index, ["bucket", "key"], "left_semi").select(F.col("key").alias(key)), "known-keys")


def rows_of_new_keys(table: DataFrame, table_path: str, new: DataFrame, key: str) -> DataFrame:
    """The rows of ``new`` whose key the table at ``table_path`` doesn't hold (all of a key's rows)."""
    known = known_keys(new.sparkSession, table, table_path, new.select(key).distinct(), key)
    return new.join(known, key, "left_anti").select(*new.columns)
