"""WARC archives of pages, and a capture index by external merge.

Writing: each task turns its pages into WARC/1.1 records, every record a gzip member of its own, and
Spark's text writer puts them into the shared folder; the separator that it writes after each row is
an empty gzip member, so a file is a sequence of members as the format asks. Of records with equal
payloads of ``least`` bytes or more the one with the smallest page id is a response; the others are
revisits that refer to it and hold no payload.

Reading: archives are read back as files, each record by its Content-Length. That gives captures:
URL key (host reversed), timestamp, place in the archive.

Index: each task sorts its captures by URL key, timestamp and id, a run; runs are dealt by range of
that whole key, so a URL with any share of all captures spreads over ranges, and within a range the
runs are merged k ways by a loser tree. Ranges in order are the globally ordered capture histories. There
are as many ranges as keep each to about ``RANGE`` captures, so what a task holds doesn't grow with the
archive; Spark's shuffle brings a range's runs together sorted by run.

Null payloads and empty ones are responses of no bytes; null URLs have an empty key. Repeated rows are
captures of their own (all but one revisits if long enough; of equal ids one is the response).
An empty table gives an empty archive and index.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentrisk.llm.common import lookup, small_side
from contentrisk.operators.tables import write_table
from contentrisk.session import scratch_path

#: Payloads of fewer bytes are never revisits.
LEAST = 100
#: Records in an archive file, at most.
RECORDS = 20_000
#: Second 0 of pages without a date of their own: they get this plus a second a page id.
EPOCH = 1_704_067_200
VERSION = b"WARC/1.1"
#: Captures of a range of the index, on average: what one task merges in memory.
RANGE = 50_000
#: Bytes given to the decompressor at a time.
PIECE = 8192
KEY = ["urlkey", "captured_at", "page_id", "row"]


def member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


#: An empty gzip member, each byte a character of ISO-8859-1.
SEPARATOR = member(b"").decode("latin-1")


def url_key(url: str | None) -> str:
    """Host reversed and comma-joined, then path and query, in lower case: sorts by site."""
    try:
        u = urlsplit((url or "").strip())
        host, port = u.hostname or "", u.port
    except ValueError:
        return (url or "").strip().lower()
    if not host:
        return (url or "").strip().lower()
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{host}{f':{port}' if port and port not in (80, 443) else ''}){u.path or '/'}{'?' + u.query if u.query else ''}".lower()


def header_safe(text: str | None) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in text or "")


def record(row: int, page_id, url, date: str, payload: bytes, digest: str, first_row: int | None, first_id: int | None) -> bytes:
    """One record; a revisit holds no payload but its size and digest, and names the record that does."""
    kind, block = ("response", payload) if first_row is None else ("revisit", b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{row}>"), ("WARC-Date", date), ("WARC-Target-URI", header_safe(url)),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if first_row is not None:
        head += [("WARC-Refers-To", f"<urn:page:{first_row}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        if first_id is not None:
            head.append(("X-Refers-To-Page-ID", str(first_id)))
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header, block) of an archive's records; offsets of gzip members."""
    view, at = memoryview(data), 0
    while at < len(data):
        d, parts, end = zlib.decompressobj(31), [], at
        while not d.eof and end < len(data):   # in small pieces: what follows the member is copied back
            parts.append(d.decompress(view[end:end + PIECE]))
            end = min(len(data), end + PIECE)
        if not d.eof:
            raise ValueError(f"the archive ends within a record, at byte {at}")
        text, size = b"".join(parts), end - at - len(d.unused_data)
        if text:
            head, _, rest = text.partition(b"\r\n\r\n")
            lines = head.decode("utf-8", "surrogatepass").split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            n = int(fields["Content-Length"])
            if lines[0].encode() != VERSION or len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
                raise ValueError(f"not a record, at byte {at}")
            yield at, size, fields, rest[:n]
        at += size


def decisions(pages: DataFrame, least: int) -> DataFrame:
    """(digest, first, n): payloads of ``least`` bytes or more that come more than once, the smallest
    page id, and by the row number the record that has them. Narrow rows; combined before the shuffle."""
    big = pages.filter(F.octet_length("html") >= least).select("id", "row", F.sha2("html", 256).alias("digest"))
    return (big.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("f"), F.count("*").alias("n"))
            .filter("n > 1").select("digest", F.col("f.id").alias("first"), F.col("f.row").alias("first_row"), "n"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", date_col: str | None = None) -> None:
    """Write a record for every row of ``pages`` to the folder ``path``."""
    date = F.col(date_col).cast("timestamp") if date_col else F.timestamp_seconds(F.coalesce(F.col(id_col).cast("long"), F.lit(0)) + EPOCH)
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.date_format(F.to_utc_timestamp(date, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = write_table(rows, "warc-pages")   # a row's number is given once, whatever the input is made of
    twice = write_table(decisions(rows, least), "warc-twice")
    keyed = rows.withColumn("digest", F.sha2("html", 256))
    few = small_side(twice.drop("n"))
    if not few.sameSemantics(twice.drop("n")):   # it got the hint
        known = keyed.join(few, "digest", "left")
    else:
        # many payloads come again: theirs by hot and cold digests, the rest as they are
        known = lookup(keyed, twice, "digest", "n").unionByName(
            keyed.join(twice.select("digest"), "digest", "left_anti"), allowMissingColumns=True)
    again = f"octet_length(html) >= {least} AND row <> first_row"
    known = known.withColumns({"first_row": F.expr(f"CASE WHEN {again} THEN first_row END"), "first": F.expr(f"CASE WHEN {again} THEN first END")})
    columns = ["row", "id", "url", "date", "html", "first_row", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for row, i, url, day, html, first_row, first_id in zip(*[b.column(c).to_pylist() for c in columns]):
                payload = html.encode("utf-8", "surrogatepass")
                made.append(member(record(row, i, url, day, payload, hashlib.sha256(payload).hexdigest(), first_row, first_id)))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    out = known.select(*columns).mapInArrow(run, "record binary")
    (out.select(F.col("record").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", SEPARATOR).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", RECORDS).text(path))


CAPTURE = ("row long, page_id long, url string, urlkey string, captured_at string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, file string, offset long, length long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A capture for every record; a response's size and digest are those of the block that was read."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                rows = []
                for at, size, h, block in records(data):
                    new = h["WARC-Type"] == "response"
                    digest = hashlib.sha256(block).hexdigest() if new else h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if new and f"sha256:{digest}" != h["WARC-Payload-Digest"]:
                        raise ValueError(f"{name}: payload differs from its digest, at byte {at}")
                    to = h.get("X-Refers-To-Page-ID")
                    rows.append((int(h["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")), int(h["X-Page-ID"]) if "X-Page-ID" in h else None,
                                 h["WARC-Target-URI"], url_key(h["WARC-Target-URI"]), h["WARC-Date"], len(block) if new else int(h["X-Payload-Length"]),
                                 digest, h["WARC-Type"], int(to) if to else None, name.rsplit("/", 1)[-1], at, size))
                    if len(rows) == 4096:
                        yield capture_batch(rows)
                        rows = []
                if rows:
                    yield capture_batch(rows)

    return files.mapInArrow(run, CAPTURE)


TYPES = {"string": pa.string(), "long": pa.int64()}


def capture_batch(rows: list[tuple], names: str = CAPTURE) -> pa.RecordBatch:
    fields = [f.split() for f in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, TYPES[t]) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def loser_tree(runs: list[list]) -> Iterator:
    """Merge sorted runs: each match's loser stays at its node, the winner goes up; after an item is
    taken, only the matches on its run's path are played again."""
    k = len(runs)
    if not k:
        return
    at = [0] * k

    def less(a: int, b: int) -> bool:   # an ended run loses; equal items go by run
        if at[a] == len(runs[a]) or at[b] == len(runs[b]):
            return at[b] == len(runs[b]) and (at[a] < len(runs[a]) or a < b)
        x, y = runs[a][at[a]], runs[b][at[b]]
        return x < y or (not y < x and a < b)

    tree, winner = [-1] * (2 * k), list(range(-k, k))   # leaves k..2k-1 are the runs
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], tree[node] = (a, b) if less(a, b) else (b, a)
    top = winner[1] if k > 1 else 0
    while at[top] < len(runs[top]):
        yield runs[top][at[top]]
        at[top] += 1
        node = (top + k) >> 1
        while node:
            if less(tree[node], top):
                tree[node], top = top, tree[node]
            node >>= 1


def merge_index(captures: DataFrame, path: str | None = None) -> DataFrame:
    """The captures in global order of URL key, timestamp and id: ``shard`` and, within it, ``place``."""
    spark = captures.sparkSession
    base = captures.select(*[f.split()[0] for f in CAPTURE.split(", ")])
    # runs: what one task read, sorted; written, so that merging reads finished runs
    runs = base.withColumn("run", F.spark_partition_id().cast("long")).sortWithinPartitions(*KEY)
    runs = write_table(runs, "warc-runs")
    n = max(1, -(-runs.count() // RANGE))
    ranged = runs.repartitionByRange(n, *KEY).sortWithinPartitions("run", *KEY)   # each range: its runs, one after the other
    names = [f.split()[0] for f in CAPTURE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        whole = pa.Table.from_batches(table).combine_chunks()
        cols = [whole.column(c).to_pylist() for c in KEY]
        keys = [(u, t, -1 if i is None else i, r) for u, t, i, r in zip(*cols)]
        of = whole.column("run").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        merged = [k for _, k in loser_tree([[(keys[k], k) for k in range(a, b)] for a, b in zip(cuts, cuts[1:])])]
        out = whole.select(names).take(pa.array(merged))
        shard = TaskContext.get().partitionId()
        out = out.append_column("shard", pa.array(np.full(len(of), shard, np.int64))).append_column("place", pa.array(np.arange(len(of))))
        yield from out.to_batches(4096)

    return write_table(ranged.mapInArrow(run, CAPTURE + ", shard long, place long"), "warc-index", path=path)


def archive(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as archives to ``path`` (by default a new folder in the shared one), read them
    back and return the merged index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archive(pages, path, **columns)
    return merge_index(read_archive(spark, path))
