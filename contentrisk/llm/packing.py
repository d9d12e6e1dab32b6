"""Token-id output: documents packed into rows of a fixed number of ids.

Each task packs the documents it reads, in blocks of about ``BLOCK_TOKENS`` tokens: a document and
its end token longer than a row is split into full rows and a rest, losing nothing; the pieces are
then placed longest first, each into the open row with the least room that still fits (best-fit
decreasing), found in a segment tree over the room left. Rows are written as Parquet: ids as
little-endian integers, padded; cumulative segment lengths; places where positions start anew; and
each segment's document, its offset in it and its row number in the block, from which documents
can be put together again.

Null and empty texts are one end token. Repeated rows are documents of their own, null ids stay
null. An empty table gives no rows. Rows depend only on the order in which a task reads, so a task
that runs again writes the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.llm.common import slices, text_array
from contentrisk.llm.tokens import Tokenizer, load_ranks
from contentrisk.operators.tables import write_table

BLOCK_TOKENS = 1 << 20
SCHEMA = ("pack_id string, n_tokens int, n_segments int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "doc_ids array<long>, doc_offsets array<long>, doc_rows array<long>")


class Rooms:
    """Open rows by the room left, in a segment tree that counts rows below each node."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room of ``need`` or more (the one opened last of equals), and its room."""
        at, count = need + self.size, self.count
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):  # up to a right neighbour with rows
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        self._add(room, -1)
        return row, room


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """The pieces of each row, longest pieces placed first (of equal ones the first)."""
    rooms, rows = Rooms(capacity), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        found = rooms.take(n)
        if found is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row, room = found
        rows[row].append(i)
        if room > n:
            rooms.put(room - n, row)
    return rows


def pack_block(ids: np.ndarray, starts: np.ndarray, doc_ids: list, capacity: int, eos: int, width: str, name: str) -> Iterator[tuple]:
    """Rows of one block; ``starts`` bounds the documents' ids."""
    n = len(starts) - 1
    size = np.diff(starts) + 1   # with the end token
    whole = np.empty(len(ids) + n, np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    last = np.zeros(len(whole), bool)
    last[at[1:] - 1] = True
    whole[last], whole[~last] = eos, ids
    # pieces: full rows, and rests
    parts = -(-size // capacity)
    doc = np.repeat(np.arange(n), parts)
    offset = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * capacity
    length = np.minimum(capacity, size[doc] - offset)
    for k, row in enumerate(best_fit(length, capacity)):
        out = np.full(capacity, eos, width)
        cu = [0]
        for p in row:
            begin = at[doc[p]] + offset[p]
            out[cu[-1]:cu[-1] + length[p]] = whole[begin:begin + length[p]]
            cu.append(cu[-1] + int(length[p]))
        yield (f"{name}-{k}", cu[-1], len(row), out.tobytes(), cu, cu[:-1], [doc_ids[doc[p]] for p in row],
               [int(offset[p]) for p in row], [int(doc[p]) for p in row])


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
         eos: int | None = None, path: str | None = None) -> DataFrame:
    """Write the packed rows to ``path`` (by default a new folder in the shared one) and return the
    written table. ``eos`` (default: one past the vocabulary) ends documents and fills rows; ids take
    two bytes if the vocabulary allows it, else four."""
    ranks = load_ranks(vocabulary)
    most = max(int(line.split()[1]) for line in ranks.splitlines() if line) + 1
    end = most if eos is None else eos
    width = "<u2" if max(most, end) < 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part = Tokenizer(ranks), TaskContext.get().partitionId()
        held: list[tuple] = []
        block = 0

        def flush():
            nonlocal block
            ids, starts, at = [h[0] for h in held], [np.zeros(1, np.int64)], 0
            for h in held:
                starts.append(h[1][1:] + at)
                at += len(h[0])
            rows = pack_block(np.concatenate(ids), np.concatenate(starts), [d for h in held for d in h[2]], capacity, end, width, f"{part}-{block}")
            held.clear()
            block += 1
            chunk = []
            for r in rows:
                chunk.append(r)
                if len(chunk) == 512:
                    yield batch_of(chunk)
                    chunk = []
            if chunk:
                yield batch_of(chunk)

        waiting = 0
        for batch in batches:
            for one in slices(batch, "text"):
                ids, starts = tok.encode(text_array(one.column("text")))
                held.append((ids, starts, one.column("id").to_pylist()))
                waiting += len(ids) + one.num_rows
                if waiting >= BLOCK_TOKENS:
                    yield from flush()
                    waiting = 0
        if held:
            yield from flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return write_table(rows.mapInArrow(run, SCHEMA), "packed", path=path)


ARROW = pa.schema([("pack_id", pa.string()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()), ("input_ids", pa.binary()),
                   ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())),
                   ("doc_offsets", pa.list_(pa.int64())), ("doc_rows", pa.list_(pa.int64()))])


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)
