"""Landed JSON arrays of any size, read by many tasks.

Spark's ``multiLine`` reads a file in one task, as a record may go over lines. Here a file is read as text
cut at ``}``, which Spark's text source can begin anywhere in the file, so a large array is dealt over as many
tasks as its size makes splits. Where a task starts it can't know whether it stands inside a string or how
deep the brackets are, but it can tell how its part changes both, for either start:

1. each split of a file of several says whether it turns inside to outside of a string, and its change of
   depth if it starts outside and if it starts inside one: one narrow row a split;
2. these are combined from the file's start on, which gives every split its true start;
3. with that, each task cuts its part into records. A record that goes over the end of a split is put
   together from its pieces, which are few and meet by their number.

A cut never falls within an escape, as the character before it is ``}``. Records are the objects of the
outermost array, or the objects of a file that holds no array (one, or one after the other).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.operators.tables import write_table

_OPEN, _CLOSE = list(b"[{"), list(b"]}")
#: Splits' starts are broadcast up to this many (narrow) rows; beyond, texts are shuffled to them.
BROADCAST_SPLITS = 200_000


def _outside(b: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """Which bytes stand outside strings, and whether the text ends inside one."""
    back = b == 0x5C
    # a quote is escaped behind an odd number of backslashes
    at = np.arange(len(b))
    before = np.maximum.accumulate(np.where(back, -1, at)) if len(b) else at   # the last byte that is no backslash
    quote = np.flatnonzero(b == 0x22)
    run = quote - 1 - np.where(quote > 0, before[quote - 1], -1)
    quote = quote[run % 2 == 0]
    turns = np.zeros(len(b) + 1, np.int64)
    turns[quote + 1] = 1       # a quote's own place counts as outside when it opens
    state = (np.cumsum(turns) + inside) % 2
    return state[:-1] == 0, bool(state[-1])


def _steps(b: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """The change of depth at each byte."""
    return np.where(outside, np.isin(b, _OPEN).astype(np.int64) - np.isin(b, _CLOSE), 0)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.RecordBatch, bytes]]:
    """Runs of rows of one split: (path, start), whether it is the split's first, the rows, their bytes."""
    last = None
    for batch in batches:
        path, start = batch.column("path").to_pylist(), batch.column("start").to_numpy()
        cut = [0, *[k for k in range(1, len(path)) if path[k] != path[k - 1] or start[k] != start[k - 1]], len(path)]
        for a, z in zip(cut, cut[1:]):
            if z > a:
                own = (path[a], int(start[a]))
                rows = batch.slice(a, z - a)
                yield own, own != last, rows, b"".join(v.encode() + b"}" for v in rows.column("value").to_pylist())
                last = own


def scan_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, value): the files' text between the ``}``, in order within a split."""
    return (spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.coalesce("value", F.lit("")).alias("value")))


def split_states(pieces: DataFrame) -> DataFrame:
    """Of every split: does it turn inside to outside; its change of depth from outside and from inside; the
    first bracket that it holds outside strings, if it starts there."""
    made = pa.schema([("path", pa.string()), ("start", pa.int64()), ("turns", pa.bool_()),
                      ("depth_out", pa.int64()), ("depth_in", pa.int64()), ("root", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for own, first, _, text in _parts(batches):
            if first:
                if now:
                    yield pa.RecordBatch.from_pylist([now], made)
                now = {"path": own[0], "start": own[1], "turns": False, "depth_out": 0, "depth_in": 0, "root": None}
            b = np.frombuffer(text, np.uint8)
            outside, inside = _outside(b, now["turns"])
            up, down = _steps(b, outside), _steps(b, ~outside)
            now["depth_out"] += int(up.sum())
            now["depth_in"] += int(down.sum())
            if now["root"] is None and up.any():
                now["root"] = chr(b[np.flatnonzero(up)[0]])
            now["turns"] = inside
        if now:
            yield pa.RecordBatch.from_pylist([now], made)

    return pieces.mapInArrow(run, "path string, start long, turns boolean, depth_out long, depth_in long, root string")


def split_starts(states: DataFrame) -> DataFrame:
    """(path, start, inside, depth, level): what is true at each split's start, and the depth around a
    record. A file's splits, one narrow row each, are combined in order."""
    of_file = Window.partitionBy("path").orderBy("start")
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    s = states.withColumn("inside", F.coalesce(F.sum(F.col("turns").cast("int")).over(before) % 2, F.lit(0)) == 1)
    s = s.withColumn("change", F.when(F.col("inside"), F.col("depth_in")).otherwise(F.col("depth_out")))
    s = s.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    whole = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", F.when(F.first("root", ignorenulls=True).over(whole) == "[", 1).otherwise(0))
    return s.select("path", "start", "inside", "depth", "level")


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, record): the text of each record of the JSON files."""
    pieces = scan_pieces(spark, path)
    starts = write_table(split_starts(split_states(pieces)), "json-splits")
    several = starts.count()
    if several <= BROADCAST_SPLITS:
        told = pieces.join(F.broadcast(starts), ["path", "start"], "left")
    else:
        told = (pieces.withColumn("place", F.monotonically_increasing_id()).join(starts, ["path", "start"], "left")
                .repartition("path", "start").sortWithinPartitions("path", "start", "place").drop("place"))
    told = told.select("path", "start", "value", "inside", "depth", "level")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "start", "part", "record"]
        state = None   # of a split: where it is, inside a string?, depth, level, the open record's text, was it open at the start?

        def left_open():
            """The open record's piece at a split's end: part 1, or part 2 if the whole split lies within one record."""
            if state and state["open"]:
                yield (state["own"][0], state["own"][1], 2 if state["head"] else 1, state["text"])

        def batch_of(found):
            if found:
                cols = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                                                  pa.array([t.decode() for t in cols[3]], pa.string())], names)

        for own, first, rows, text in _parts(batches):
            found = []
            if first:
                found += left_open()
                r = rows.slice(0, 1).to_pylist()[0]
                state = {"own": own, "inside": bool(r["inside"]), "depth": int(r["depth"] or 0), "level": int(r["level"] or 0), "text": b""}
                state["open"] = state["head"] = state["depth"] > state["level"]
            b = np.frombuffer(text, np.uint8)
            outside, inside = _outside(b, state["inside"])
            depth = state["depth"] + np.cumsum(_steps(b, outside))
            level, at = state["level"], 0
            begins = np.flatnonzero(outside & (b == 0x7B) & (depth == level + 1))
            ends = np.flatnonzero(outside & (b == 0x7D) & (depth == level))
            marks = sorted([(int(k), 0) for k in begins] + [(int(k), 1) for k in ends])
            for k, closes in marks:
                if not closes:
                    at, state["open"], state["head"], state["text"] = k, True, False, b""
                elif state["open"]:
                    found.append((own[0], own[1], 0 if state["head"] else -1, state["text"] + text[at:k + 1]))
                    state["open"] = state["head"] = False
                    state["text"] = b""
            if state["open"]:
                state["text"] += text[at:]
            state["inside"], state["depth"] = inside, int(depth[-1]) if len(b) else state["depth"]
            yield from batch_of(found)
        yield from batch_of(list(left_open()))

    cut = write_table(told.mapInArrow(run, "path string, start long, part int, record string"), "json-records")
    # part -1: whole; 1: begun; 2: goes on; 0: ended. A record's pieces follow each other
    parts = cut.filter("part >= 0")
    number = F.sum((F.col("part") == 1).cast("int")).over(Window.partitionBy("path").orderBy("start", "part"))
    joined = (parts.select("path", "start", "part").withColumn("number", number).join(parts, ["path", "start", "part"])
              .groupBy("path", "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "part", "record"))), lambda p: p["record"]), "").alias("record")))
    return cut.filter("part < 0").select("path", "record").unionByName(joined.select("path", "record"))


def scan_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of JSON array files as declared, whatever the files' size. A record that is no JSON
    gives a row of nulls, as Spark's own reader does."""
    return scan_records(spark, path).select(F.from_json("record", schema).alias("r")).select("r.*")
