"""Operator 3: WARC archives, and an index of them merged from sorted runs.

``write_archives`` turns page rows into WARC/1.1 records in gzip files. Spark's text sink
writes them (a record ends with two CRLF, which is the sink's line separator),
so archives go to any file system that Spark can reach. Of records with equal
payloads the one with the largest id is the response; the others are revisits
that refer to it and carry no payload.

A file is rolled by bytes: it holds ``ARCHIVE_BYTES`` of records, or one larger
record.

``read_archives`` reads the files back and parses records by their declared
lengths, so a payload may hold anything, record headers included. Each file is
one capture run: its entries are sorted by URL key and timestamp where the file
is parsed, and written to the shared folder as a run.

``merge_runs`` orders the captures globally. Keys sampled from the runs bound
ranges of about ``RANGE_ROWS`` captures by URL key, timestamp and record id (a
URL with very many captures spans ranges), so what a task merges at once is
bounded however large the index is. A task gets the slices of all runs that
reach into its range, each in its run's order, merges them with a loser tree and
hands the result on batch by batch.

Defined cases: NULL html is an empty payload; NULL url has an empty URL key;
equal payloads are equal bytes (SHA-1 and length); pages that share the largest
id of a payload are all responses; a NULL id is smaller than any other; repeated
rows are records of their own; pages of any length are written whole; an empty
table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import materialise
from sheaf.session import scratch_path

#: Bytes of an archive file, unpacked: what a reading task holds at once. Captures of a range: what a merging task holds.
ARCHIVE_BYTES, RANGE_ROWS = 32 * 1024 * 1024, 100_000
MERGED_ROWS = 10_000  # captures of a merged batch
#: When the first page was captured; page ``n`` was captured ``n`` seconds later.
FIRST_CAPTURE = dt.datetime(2024, 1, 1)

INDEX = ("page_id long, url string, url_key string, captured string, record_type string, payload_digest string, "
         "own_bytes long, refers_to long, archive string, position long")
#: What a run is sorted by.
ORDER = ["url_key", "captured", "page_id", "position"]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, port and ``www`` left out, fragment dropped, A-Z lowered."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return (url or "").lower()
    if not host:
        return (url or "").lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){(parts.path or '/') + query}".lower()


def captured(page_id: int | None) -> str:
    """ISO time of a capture; ids whose time no calendar holds wrap round."""
    seconds = (page_id or 0) % (86_400 * 365 * 900)
    return (FIRST_CAPTURE + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id: int | None, url: str | None, html: str, sha1: str, size: int, refers_to: int | None) -> str:
    """One record without its closing CRLFs. HTTP headers precede the payload; a revisit stops after them."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http if revisit else http + html
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {captured(page_id)}", f"WARC-Target-URI: {target}",
            f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response",
            f"X-Page-ID: {'' if page_id is None else page_id}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block.encode('utf-8', 'replace'))}")
    return "\r\n".join(head) + "\r\n\r\n" + block


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) under ``path``."""
    def archive(held: list[str]) -> pa.RecordBatch:
        """Records of one file as one value: the sink ends it as each record ends."""
        return pa.RecordBatch.from_arrays([pa.array(["\r\n\r\n".join(held)], pa.string())], names=["value"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "last")), strict=True):
                own, url, html, last = (v.as_py() for v in row)
                raw = (html or "").encode("utf-8", "replace")
                refers_to = None if last is None or own == last else last
                if held and size + len(raw) > ARCHIVE_BYTES:
                    yield archive(held)
                    held, size = [], 0
                held.append(record(own, url, html or "", digest(raw), len(raw), refers_to))
                size += 1_000 + (len(raw) if refers_to is None else 0)
        if held:
            yield archive(held)

    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(raw).alias("hex"),
                       F.octet_length(raw).alias("size"))
    # Only payloads that stand more than once need their response looked up; any other is its own.
    last = own.groupBy("hex", "size").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    last = last.where("n > 1").select(F.col("hex").alias("h"), F.col("size").alias("s"), "last")
    joined = own.join(last, (F.col("hex") == F.col("h")) & (F.col("size") == F.col("s")), "left")
    lines = joined.select("page_id", "url", "html", "last").mapInArrow(records, "value string")
    (lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1)
     .option("compression", "gzip").text(path))


def parse(content: bytes, archive: str) -> Iterator[tuple]:
    """Index entries of an archive's records, in file order. Damaged input raises."""
    at = 0
    if content[:2] == b"\x1f\x8b":  # gzip; positions count in the unpacked archive
        content = gzip.decompress(content)
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].split(b"\r\n") if end >= 0 else []
        if not lines or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"{archive}: no record at {at}")
        head = {k.strip().lower(): v.strip().decode("utf-8", "replace")
                for k, _, v in (line.partition(b":") for line in lines[1:])}
        start = end + 4
        stop = start + int(head[b"content-length"])
        if content[stop: stop + 4] != b"\r\n\r\n":
            raise ValueError(f"{archive}: the record at {at} is cut short")
        body = content.find(b"\r\n\r\n", start, stop) + 4
        own, to, url = head[b"x-page-id"], head.get(b"x-refers-to-page-id"), head[b"warc-target-uri"]
        kind, said = head[b"warc-type"], head[b"warc-payload-digest"].removeprefix("sha1:")
        payload = content[body:stop]
        if kind == "response" and digest(payload) != said:
            raise ValueError(f"{archive}: the payload at {at} doesn't have its digest")
        yield (int(own) if own else None, url, url_key(url), head[b"warc-date"], kind, said,
               len(payload) if kind == "response" else None, int(to) if to else None, archive, at)
        at = stop + 4


def sort_key(entry: tuple) -> tuple:
    return entry[2], entry[3], entry[0] is not None, entry[0] or 0, entry[9]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives under ``path``; those of one archive come sorted, as one run."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), *((n, pa.string()) for n in (
            "url", "url_key", "captured", "record_type", "payload_digest")), ("own_bytes", pa.int64()),
            ("refers_to", pa.int64()), ("archive", pa.string()), ("position", pa.int64())])
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                run = sorted(parse(content.as_py(), name.rsplit("/", 1)[-1]), key=sort_key)
                columns = zip(*run, strict=True) if run else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(work, INDEX)


class LoserTree:
    """K-way merge: an inner node holds the run that lost there, the root the overall winner."""

    def __init__(self, runs: Iterable[Iterator], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.heads = [self._next(i) for i in range(len(self.runs))]
        k = len(self.runs)
        self.losers = [-1] * k
        for i in range(k):  # play each run up the tree; the first to come waits
            self._play(i, building=True)

    def _next(self, i: int) -> tuple:
        entry = next(self.runs[i], None)
        return (1,) if entry is None else (0, self.key(entry), i, entry)

    def _play(self, i: int, building: bool = False) -> None:
        node = (i + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if building and other < 0:
                self.losers[node] = i
                return
            if self.heads[other][:3] < self.heads[i][:3]:
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator:
        while self.runs:
            i = self.losers[0]
            if self.heads[i][0]:
                return
            yield self.heads[i][3]
            self.heads[i] = self._next(i)
            self._play(i)


def merge_runs(entries: DataFrame) -> DataFrame:
    """Captures in global order of ``ORDER``; ``shard`` and ``place`` give the place (range shard, row in it)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[pa.RecordBatch]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            # Rows come run by run: a batch is cut where the next run starts.
            archives = batch.column(8).to_pylist()
            edges = [0, *(i for i in range(1, len(archives)) if archives[i] != archives[i - 1]), len(archives)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi > lo:
                    slices.setdefault(archives[lo], []).append(batch.slice(lo, hi - lo))

        def rows(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
            for part in parts:
                for at in range(0, part.num_rows, 256):  # rows become tuples as the merge gets to them
                    yield from zip(*(c.to_pylist() for c in part.slice(at, 256).columns), strict=True)

        merged, at = iter(LoserTree(map(rows, slices.values()), sort_key)), 0
        while part := list(itertools.islice(merged, MERGED_ROWS)):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)]
            places = pa.array(range(at, at + len(part)), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, places], names=[*schema.names, "place"])
            at += len(part)

    runs = materialise(entries, "runs")
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, *ORDER).sortWithinPartitions("archive", *ORDER)
    return dealt.mapInArrow(work, f"{INDEX}, place long").withColumn("shard", F.spark_partition_id())


def capture_histories(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives, read them back, and merge their index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    merged = materialise(merge_runs(read_archives(spark, path)), "captures")
    # A revisit's payload size is that of the record it refers to.
    sizes = (merged.where("record_type = 'response'").groupBy("payload_digest", "page_id").agg(F.max("own_bytes").alias("bytes"))
             .select(F.col("payload_digest").alias("d"), F.col("page_id").alias("p"), "bytes"))
    sizes = sizes.join(merged.where("refers_to is not null").select(
        F.col("payload_digest").alias("d"), F.col("refers_to").alias("p")).distinct(), ["d", "p"], "left_semi")
    full = merged.join(sizes, (F.col("payload_digest") == F.col("d")) & (F.col("refers_to") == F.col("p")), "left")
    return full.select("page_id", F.coalesce("own_bytes", "bytes").alias("payload_bytes"), "payload_digest", "record_type",
                       "refers_to", "url_key", "captured", "archive", "position", "shard", "place")
