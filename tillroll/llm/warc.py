"""WARC archives: written and read by Spark, and merged into one ordered capture index.

Writing: payloads are hashed; of records with equal payloads of at least ``MIN_REVISIT`` bytes the
one with the smallest id is a response, the others revisit it. Spark's text writer lays the records
down (the blank lines that end a WARC record are its line separator) in gzip files of a bounded
number of bytes, through Spark's own commit protocol: a lost executor leaves no half archive.

Reading: one file at a time, record by record, by the lengths in the headers. Archives of other
writers are read too: records that are no captures are passed over, and what a header does not say
is left out or worked out from the record. The captures of one file, sorted by URL key and timestamp, are a run. Runs are dealt out by ranges of (URL key,
timestamp, id), so a URL with very many captures is cut over several ranges, and in each range
the runs that reach into it are merged by a loser tree. Ranges follow one another, so the result
is one globally ordered capture history.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import re
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tillroll.llm.common import scratch_path, settle

MIN_REVISIT = 100
#: Bytes of records in one archive, before compression, until which records are added to it.
BYTES_PER_FILE = 64 << 20
#: Captures that one range of the merge holds, about; a capture of the index has some 200 bytes.
CAPTURES_PER_RANGE = 100_000
#: First capture date where a page brings none; ids count seconds from here.
EPOCH = "2024-01-01 00:00:00"
EPOCH_SPAN = 1_000_000_000
SEPARATOR = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: F.Column) -> F.Column:
    """Sort key of a URL: host labels from the right, then path and query; no scheme, no fragment."""
    low = F.lower(F.coalesce(url, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://", ""), "#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r"^www\d*\.", "")
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    return F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","),
        F.lit(")"),
        F.when(rest == "", "/").otherwise(rest),
    )


def _one_line(text: F.Column) -> F.Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]", "%0A")


def revisits(pages: DataFrame) -> DataFrame:
    """``pages`` (id, url, captured_at, payload) with digest and, for revisits, the id revisited.

    Ids of first records are found by a minimum per digest, which combines before the shuffle; the
    join with them is a plain one, which Spark splits where one payload has very many records.
    """
    hashed = pages.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "size", F.octet_length("payload").cast("long")
    )
    long = hashed.filter(F.col("size") >= MIN_REVISIT)
    firsts = settle(
        long.groupBy(F.col("digest").alias("first_digest"))
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n"),
        "first-records",
    )
    joined = hashed.join(firsts, hashed["digest"] == firsts["first_digest"], "left")
    return joined.select(
        "id", "url", "captured_at", "payload", "digest", "size",
        F.when(F.col("first_id") < F.col("id"), F.col("first_id")).alias("refers_to"),
    )


def _record() -> F.Column:
    """One WARC record as a string, without the blank lines at its end."""
    line = F.lit("\r\n")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK"), line,
        F.lit("Content-Type: text/html; charset=utf-8"), line,
        F.lit("Content-Length: "), F.col("size").cast("string"), line, line,
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    named = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    return F.concat(
        F.lit("WARC/1.1"), line,
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), line,
        F.lit("WARC-Record-ID: <urn:page:"), named, F.lit(">"), line,
        F.lit("WARC-Target-URI: "), _one_line(F.col("url")), line,
        F.lit("X-Url-Key: "), _one_line(url_key(F.col("url"))), line,
        F.lit("WARC-Date: "), F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), line,
        F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), line,
        F.when(
            revisit,
            F.concat(
                F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"),
                line, F.lit(f"WARC-Profile: {REVISIT_PROFILE}"), line,
            ),
        ).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response"), line,
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), line, line,
        block,
    )


def _numbered(bytes_per_file: int):
    """The records with the number of their archive, which none shares with another task."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, size = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("value")).to_numpy().astype(np.int64)
            begins = size + np.cumsum(lengths) - lengths
            size += int(lengths.sum())
            archives = pa.array([f"{task:06d}-{number:06d}" for number in (begins // bytes_per_file).tolist()])
            yield pa.RecordBatch.from_arrays([batch.column("value"), archives], ["value", "archive"])

    return numbered


def write_archives(pages: DataFrame, path: str, bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Write a record per row of ``pages`` (page_id, url, html; captured_at if there is one).

    A null html is an empty payload, a null url an empty one. Records of fewer than ``MIN_REVISIT``
    bytes, and rows without an id, are responses; so are rows that repeat the first record with
    its id. An empty table gives an archive folder without records. Other columns are ignored.
    Where captured_at is null or no timestamp, the id gives the date.
    """
    step = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)).cast("long"), F.lit(EPOCH_SPAN))
    seconds = F.unix_timestamp(F.lit(EPOCH)) + step
    date = F.timestamp_seconds(seconds)
    if isinstance({f.name: f.dataType for f in pages.schema.fields}.get("captured_at"), (TimestampType, TimestampNTZType)):
        date = F.coalesce(F.col("captured_at").cast("timestamp"), date)
    rows = pages.select(
        F.col("page_id").cast("long").alias("id"),
        "url",
        date.alias("captured_at"),
        F.coalesce("html", F.lit("")).alias("payload"),
    )
    (
        revisits(rows)
        .select(_record().alias("value"))
        .mapInArrow(_numbered(bytes_per_file), "value string, archive string")
        .write.partitionBy("archive")
        .option("lineSep", SEPARATOR)
        .option("compression", "gzip")
        .text(path)
    )


_FIELDS = [
    ("page_id", pa.int64()), ("url", pa.string()), ("url_key", pa.string()), ("captured_at", pa.string()),
    ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("refers_to", pa.int64()), ("archive", pa.string()), ("record_offset", pa.int64()),
]
CAPTURE_SCHEMA = (
    "page_id long, url string, url_key string, captured_at string, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long, archive string, record_offset long"
)
_ARROW = pa.schema(_FIELDS)


def _page_number(uri: str) -> int | None:
    """The id in a record's name, where this writer gave it."""
    name = uri.strip("<>").removeprefix("urn:page:")
    return int(name) if name.lstrip("-").isdigit() else None


def plain_url_key(url: str) -> str:
    """``url_key`` of one URL, for records that do not bring it."""
    bare = re.sub(r"#.*$", "", re.sub(r"^[a-z][a-z0-9+.-]*://", "", url.lower()))
    host, rest = re.match(r"([^/?]*)(.*)$", bare, re.DOTALL).groups()
    return ",".join(reversed(re.sub(r"^www\d*\.", "", host).split("."))) + ")" + (rest or "/")


def _headers(stream: BinaryIO) -> tuple[str, dict[str, str], int]:
    """First line, fields (names in lower case) and length of a header block; length 0 at the end of the stream only."""
    first = stream.readline()
    if not first:
        return "", {}, 0
    length, fields = len(first), {}
    while first.strip():
        line = stream.readline()
        if not line:
            raise ValueError("the archive ends within a header")
        length += len(line)
        if not line.strip():
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return first.decode("utf-8", "replace").strip(), fields, length


def parse_archive(stream: BinaryIO, name: str) -> Iterator[tuple]:
    """The captures of one archive, in the order of ``CAPTURE_SCHEMA``; one record is held at a time.

    Captures are responses and revisits; other records are passed over. The digest of a response is
    that of the payload read, and is held against the header's where that is a SHA-256. A revisit
    has the digest of its header, with its algorithm unless it is SHA-256, and the size its HTTP header
    tells, or none.
    """
    at = 0
    while True:
        version, head, head_size = _headers(stream)
        if not head_size:
            return
        if not version.startswith("WARC/") or "content-length" not in head:
            raise ValueError(f"{name}: no WARC record at {at}")
        block_size = int(head["content-length"])
        block = stream.read(block_size)
        if len(block) != block_size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{name}: the record at {at} does not end where it should")
        if head.get("warc-type") in ("response", "revisit"):
            yield _capture(head, block, name, at)
        at += head_size + block_size + 4


def _capture(head: dict[str, str], block: bytes, name: str, at: int) -> tuple:
    body = io.BytesIO(block)
    http: dict[str, str] = {}
    if "application/http" in head.get("content-type", ""):
        _, http, _ = _headers(body)
    payload = body.read()
    claimed = head.get("warc-payload-digest", "")
    told = http.get("content-length", "")
    size, digest = (int(told) if told.isdigit() else None), claimed.removeprefix("sha256:")
    if head["warc-type"] == "response":
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if claimed.startswith("sha256:") and claimed != f"sha256:{digest}":
            raise ValueError(f"{name}: the payload at {at} is not what its header says")
    url = head.get("warc-target-uri", "").strip("<>")
    refers = head.get("warc-refers-to")
    return (
        _page_number(head.get("warc-record-id", "")), url, head.get("x-url-key") or plain_url_key(url),
        head.get("warc-date", ""), head["warc-type"], size, digest,
        _page_number(refers) if refers else None, name, at,
    )


def _order(row: tuple) -> tuple:
    """URL key, timestamp, id (null first), then the record's own place."""
    return row[2], row[3], row[0] is not None, row[0] or 0, row[8], row[9]


def _read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            with gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer())) as stream:
                rows = sorted(parse_archive(stream, "/".join(path.split("/")[-2:])), key=_order)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), _FIELDS)], schema=_ARROW
                )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives under ``path``; those of one archive are in order (a run)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(_read_runs, CAPTURE_SCHEMA)


class LoserTree:
    """Merges k sorted runs: each step replays one path from a leaf to the root."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        k = len(runs)
        self.losers = [-1] * k
        for leaf in range(k):
            self._replay(leaf)

    def _before(self, a: int, b: int) -> bool:
        """Whether run ``a`` goes first; a run that is at its end goes last."""
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x < y)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other == -1:  # while the tree is built, the first to come waits here
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            winner = self.losers[0]
            head = self.heads[winner]
            if head is None:
                return
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the parts of runs that lie in this range; only it is held in memory."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    columns = [table.column(c).to_pylist() for c in ("url_key", "captured_at", "page_id", "archive", "record_offset")]
    runs: list[list[tuple]] = []
    last = None
    for i, (key, date, page, archive, offset) in enumerate(zip(*columns)):
        row = (key, date, page is not None, page or 0, archive, offset, i)
        # What a shuffle brings of a run is in order but for the blocks it came in: each is a run.
        if last is None or last[4] != archive or row < last:
            runs.append([])
        runs[-1].append(row)
        last = row
    merged = LoserTree([iter(run) for run in runs])
    order = np.fromiter((row[-1] for row in merged), np.int64, table.num_rows)
    for batch in table.take(pa.array(order)).to_batches(max_chunksize=10_000):
        yield batch


def capture_index(runs: DataFrame, per_range: int = CAPTURES_PER_RANGE) -> DataFrame:
    """All captures in order of URL key, timestamp and id, over ranges that follow one another."""
    stored = settle(runs, "capture-runs")
    return _merged(stored, stored.count(), per_range)


def _merged(stored: DataFrame, captures: int, per_range: int) -> DataFrame:
    ranges = max(1, math.ceil(captures / per_range))
    dealt = stored.repartitionByRange(ranges, "url_key", "captured_at", "page_id", "record_offset")
    return dealt.mapInArrow(_merge_runs, CAPTURE_SCHEMA)


def archive_captures(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back, and return their ordered capture index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(pages, path)
    runs = settle(read_runs(spark, path), "capture-runs")
    written, read = pages.count(), runs.count()
    if written != read:
        raise ValueError(f"{written} pages were written to {path}, and {read} records read")
    return _merged(runs, read, CAPTURES_PER_RANGE)


def records_sql(table: str = "pages") -> str:
    """Id, payload and revisit columns of ``archive_captures`` for DuckDB."""
    return f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM {table}
),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= {MIN_REVISIT} GROUP BY ALL)
SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
  CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
