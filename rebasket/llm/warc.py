"""WARC archives, and their capture index by external merge.

Archives are written by Spark's text writer (gzip): a record per line, the lines
separated by the two line ends that close a WARC record. Of captures with equal
payloads one is stored, the others are revisit records that refer to it.

Reading an archive back parses records by their lengths and gives one index run
per archive, sorted by URL key, timestamp and id. Runs are cut at common bounds
into sorted blocks; one task per range merges its blocks by a loser tree, so the
ranges, one after the other, hold the captures of the whole collection in order.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import fresh_path, stored

SHARE_FROM = 1000  # bytes; smaller payloads are always stored
RECORDS_PER_FILE = 8192
SAMPLE_PER_RANGE = 8  # index keys that the bounds of a range are taken from
_END = "\r\n"
_NONE = -(1 << 63)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    The largest page_id of equal payloads is the response; a null id is below
    all others. Equal payloads are found by digest: ids combine in the map tasks
    and meet the pages by a hash join, in which large digests can be split.
    """
    sized = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1(F.col("payload").cast("binary")))
    held = sized.filter(F.col("payload_bytes") >= SHARE_FROM).groupBy(F.col("payload_digest").alias("digest")).agg(
        F.max("page_id").alias("holder"))
    joined = sized.join(
        held.hint("shuffle_hash"),
        (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= SHARE_FROM), "left")
    again = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("holder")).alias("refers_to"),
    )


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def record(captured: Column) -> Column:
    """The WARC record of a row of ``with_revisits``, without the line ends that close it."""
    stored_here = F.col("record_type") == "response"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("payload_bytes"), F.lit(_END * 2))
    body = F.when(stored_here, F.concat(http, "payload")).otherwise(http)
    return F.concat(
        F.lit(f"WARC/1.1{_END}WARC-Type: "), "record_type",
        F.lit(f"{_END}WARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(f"{_END}WARC-Date: "), F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(f"{_END}WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20"),
        F.lit(f"{_END}WARC-Payload-Digest: sha1:"), "payload_digest",
        F.when(stored_here, "").otherwise(F.concat(
            F.lit(f"{_END}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.lit(f"{_END}WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.lit(f"{_END}Content-Type: application/http;msgtype=response{_END}Content-Length: "),
        F.octet_length(body), F.lit(_END * 2), body)


def write_archives(pages: DataFrame, path: str) -> None:
    """One record per page. Pages carry no time: the capture second is 2020-01-01 plus the page_id, modulo 2**29."""
    captured = F.timestamp_seconds(F.lit(1577836800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 29)))
    with_revisits(pages).select(record(captured).alias("value")).write.option("lineSep", _END * 2).option(
        "compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes, int]]:
    """Offset, headers, content and content's place of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode().split(_END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = head + 4
        end = start + int(headers["Content-Length"])
        yield at, headers, data[start:end], start
        at = end + 4


def url_key(url: str) -> str:
    """The URL's sort key: reversed host, then path and sorted query; scheme, user, www and fragment go."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    query = "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return f"{where}){parts.path.lower() or '/'}" + (f"?{query}" if query else "")


_ID = re.compile(r"<urn:page:(-?\d+)>")


def _number(text: str | None) -> int | None:
    found = _ID.fullmatch(text or "")
    return int(found[1]) if found else None


_ENTRY = pa.schema([
    ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
    ("archive", pa.string()), ("offset", pa.int64()),
])
ENTRY = "url_key string, captured string, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, archive string, offset long"


def order(entry: tuple) -> tuple:
    """What entries are sorted by: key, time, id (null first), archive, offset."""
    return entry[0], entry[1], _NONE if entry[2] is None else entry[2], entry[7], entry[8]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted index run of every archive."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            data = zlib.decompress(content.as_py(), wbits=31)
            name = path.rsplit("/", 1)[-1]
            run = []
            for offset, headers, body, _ in records(data):
                http = body.index(b"\r\n\r\n") + 4
                if headers["WARC-Type"] == "response":
                    payload = body[http:]
                    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    if f"sha1:{digest}" != headers["WARC-Payload-Digest"]:
                        raise ValueError(f"wrong payload at {offset} of {path}")
                else:
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(re.search(rb"Content-Length: (\d+)", body[:http])[1])
                run.append((
                    url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], _number(headers["WARC-Record-ID"]),
                    headers["WARC-Type"], digest, size, _number(headers.get("WARC-Refers-To")), name, offset))
            if run:
                run.sort(key=order)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*run), _ENTRY)], schema=_ENTRY)


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives in a folder, sorted within each archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(_index, ENTRY)


class LoserTree:
    """Merge of k sorted sequences: each inner node keeps the loser of its match, the root's winner comes next."""

    def __init__(self, runs: list[list], key):
        self.runs = [iter(r) for r in runs]
        self.key = key
        self.k = max(len(runs), 1)
        self.heads: list[tuple | None] = [self._next(i) for i in range(len(runs))]
        self.losers = [-1] * self.k
        self.winner = self._play(1) if len(runs) > 1 else 0

    def _next(self, i: int):
        entry = next(self.runs[i], None)
        return None if entry is None else (self.key(entry), i, entry)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[:2] < y[:2])

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if not self._beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.heads and self.heads[self.winner] is not None:
            at = self.winner
            yield self.heads[at][2]
            self.heads[at] = self._next(at)
            node = (at + self.k) // 2
            while node >= 1:
                if self._beats(self.losers[node], at):
                    self.losers[node], at = at, self.losers[node]
                node //= 2
            self.winner = at


def _cut(bounds: list[tuple]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of a sorted run that lie within one range; a run ends where the order breaks."""
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns]))
            blocks: list[tuple[int, list]] = []
            last = None
            for row in rows:
                key = order(row)
                if last is None or key < last or (number < len(bounds) and key > bounds[number]):
                    number = bisect_left(bounds, key)
                    blocks.append((number, []))
                blocks[-1][1].append(row)
                last = key
            yield pa.RecordBatch.from_arrays([
                pa.array([b[0] for b in blocks], pa.int32()),
                pa.array([[dict(zip(_ENTRY.names, r)) for r in b[1]] for b in blocks], pa.list_(pa.struct(_ENTRY))),
            ], names=["range", "block"])

    return cut


def _merge(group: pa.Table) -> pa.Table:
    number = group.column("range")[0].as_py()
    blocks = [[tuple(e.values()) for e in block] for block in group.column("block").to_pylist()]
    merged = list(LoserTree(blocks, order))
    return pa.Table.from_arrays(
        [pa.array([number] * len(merged), pa.int32()), pa.array(range(len(merged)), pa.int64())]
        + [pa.array(c, f.type) for c, f in zip(zip(*merged), _ENTRY)],
        names=["range", "place", *_ENTRY.names])


def merge_runs(runs: DataFrame) -> DataFrame:
    """range, place and the entries: ordered by (range, place), globally.

    The bounds between ranges are entries themselves, taken from a sample by hash
    of about ``SAMPLE_PER_RANGE`` entries per range; ranges and entries per range
    both grow with the root of the collection. Bounds hold time and id besides the
    URL key, so a URL with most of the captures is spread over many ranges.
    """
    total = runs.count()
    n = max(1, int(total ** 0.5 / 2))
    share = min(1.0, n * SAMPLE_PER_RANGE / max(total, 1))
    keys = sorted(
        order(tuple(r)) for r in runs.filter(
            F.pmod(F.xxhash64("archive", "offset"), F.lit(1 << 30)) < int(share * (1 << 30))
        ).select([F.col(c) if c in ("url_key", "captured", "page_id", "archive", "offset") else F.lit(None).alias(c) for c in _ENTRY.names]).collect())
    bounds = keys[len(keys) // n::max(1, len(keys) // n)][:n - 1] if keys else []
    return runs.mapInArrow(_cut(bounds), f"range int, block array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>").groupBy(
        "range").applyInArrow(_merge, f"range int, place long, {ENTRY}")


def capture_index(pages: DataFrame) -> DataFrame:
    """Write the pages' archives to the shared folder, read them back, merge their index.

    One entry per page. A null html is an empty payload, a null url an empty one;
    rows of equal ids and payloads are separate records, all of them responses if
    their id is the largest; a null page_id never holds others' payloads unless
    all ids of that payload are null (then all are responses). Other columns are
    ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path)
    return merge_runs(stored(index_runs(spark, path), "index-runs"))
