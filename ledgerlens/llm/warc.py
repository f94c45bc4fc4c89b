"""Operator 3, WARC archives and their index by external merge.

Writing: one record per page, in files below the shared folder, by Spark's own text writer (a record ends as a line of that
writer does, with two line ends), so any file system that Spark knows will do. Equal payloads of REVISIT_BYTES or more are
stored once; all but the one with the largest page id are revisit records. Reading streams through each file by the records'
Content-Length, recomputes digests and sorts captures locally into runs. The runs are written, dealt by sampled splitters over
(URL key, time, id, place), and each range, of about ROWS_PER_RANGE entries however often a page was captured, merges its k run slices
by a loser tree: the partitions one after the other hold all capture histories in order. An entry's offset counts the archive's bytes
before compression, as a file is one gzip member.

Defined results: a null payload is empty; a null url has an empty key; rows that repeat a page id with its payload are records
of their own and have the same type; a null page id is smaller than all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import arrow_bounds, columns, fresh_path, join_hot_left, map_arrow, read_table, record_batch, staged

REVISIT_BYTES = 1000
#: Records in one archive file, entries in one sorted run, and entries that one range of the merge should hold.
RECORDS_PER_FILE, RUN_ROWS, ROWS_PER_RANGE = 20_000, 50_000, 50_000
END = "\r\n\r\n"
_END = END.encode()
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, sha, size and refers_to (set for revisits) of every row."""
    rows = pages.select("page_id", "url", F.coalesce("payload", F.lit("")).alias("payload")).select("*", F.sha1(F.col("payload").cast("binary")).alias("sha"), F.octet_length("payload").cast("long").alias("size"))
    narrow = staged(rows.filter(F.col("size") >= REVISIT_BYTES).select("sha", "page_id"), "payloads")
    stored = narrow.groupBy("sha").agg(F.max("page_id").alias("kept_id"), F.count("*").alias("n")).filter("n > 1")
    joined = join_hot_left(rows, staged(stored, "stored"), "sha", "n", F.xxhash64("page_id"))
    return joined.select("page_id", "url", "payload", "sha", "size", F.when(~F.col("page_id").eqNullSafe(F.col("kept_id")), F.col("kept_id")).alias("refers_to"))


def records(typed: DataFrame) -> DataFrame:
    """One column, record: header and block of each WARC record, without its end."""
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    seconds = F.lit(1_700_000_000) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(300_000_000))
    when = F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    lines = [
        F.concat(F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), when),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("refers_to")))),
        F.concat(F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))),
    ]
    return typed.select(F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block).alias("record"))


def write_archives(pages: DataFrame, path: str | None = None) -> str:
    """pages: page_id, url, payload. Returns the folder of gzip archives."""
    path = path or fresh_path(pages.sparkSession, "warc")
    writer = records(record_types(pages)).write.option("lineSep", END).option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


class Stream:
    """Takes an archive's bytes piece by piece and gives its records: offset, header fields, block."""

    def __init__(self) -> None:
        self.held, self.offset, self.header, self.length = bytearray(), 0, {}, -1

    def feed(self, piece: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
        self.held += piece
        while True:
            if self.length < 0:
                at = self.held.find(_END)
                if at < 0:
                    return
                first, *lines = bytes(self.held[:at]).decode().split("\r\n")
                if not first.startswith("WARC/"):
                    raise ValueError(f"no record begins at byte {self.offset}")
                self.header = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                self.length, self.start = int(self.header["content-length"]), at + 4
            end = self.start + self.length
            if len(self.held) < end + 4:
                return
            if self.held[end : end + 4] != _END:
                raise ValueError(f"the record at byte {self.offset} does not end after its length")
            yield self.offset, self.header, bytes(self.held[self.start : end])
            del self.held[: end + 4]
            self.offset, self.length = self.offset + end + 4, -1

    def close(self) -> None:
        if self.held:
            raise ValueError(f"the record at byte {self.offset} is cut off")


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and sorted query, lower case; no scheme, `www.`, default port or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    host = host.removeprefix("www.")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "") + ")" + (parts.path.rstrip("/") or "/")
    return (key + ("?" + "&".join(sorted(parts.query.split("&"))) if parts.query else "")).lower()


ENTRY = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, run long, seq long"
_ENTRY = pa.schema([("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("run", pa.int64()), ("seq", pa.int64())])


def _id(name: str | None) -> int | None:
    text = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(text) if text else None


def _entry(archive: str, offset: int, header: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(_END)
    digest = header["warc-payload-digest"].removeprefix("sha1:")
    if header["warc-type"] == "response":
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        if found != digest:
            raise ValueError(f"{archive}: payload at byte {offset} has another digest than its header says")
    else:
        size = int(http.rpartition(b"Content-Length:")[2])
    return url_key(header.get("warc-target-uri")), header["warc-date"], _id(header["warc-record-id"]), size, digest, header["warc-type"], _id(header.get("warc-refers-to")), archive.rpartition("/")[2], offset


def sort_key(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[7], entry[8]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of the archives in sorted runs of bounded length."""
    run, rows, archive, stream = TaskContext.get().partitionId() << 24, [], None, None

    def sorted_run() -> Iterator[pa.RecordBatch]:
        ordered = [(*r, run, k) for k, r in enumerate(sorted(rows, key=sort_key))]
        for at in range(0, len(ordered), 5000):
            yield record_batch(_ENTRY, *map(list, zip(*ordered[at : at + 5000], strict=True)))

    for paths, pieces in columns(batches, "path", "value"):
        for path, piece in zip(paths.to_pylist(), pieces.cast(pa.binary()), strict=True):
            if path != archive:
                if stream:
                    stream.close()
                archive, stream = path, Stream()
            rows += [_entry(archive, *found) for found in stream.feed(piece.as_py() + _END)]
        if len(rows) >= RUN_ROWS:
            yield from sorted_run()
            run, rows = run + 1, []
    if stream:
        stream.close()
    yield from sorted_run()


class LoserTree:
    """Merges sorted lists; each step costs one comparison a level."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        if self.at[a] >= len(self.runs[a]):
            return False
        if self.at[b] >= len(self.runs[b]):
            return True
        return self.runs[a][self.at[a]] < self.runs[b][self.at[b]]

    def _play(self, i: int) -> None:
        """The run i goes up from its leaf; the loser stays at each node, the winner ends in losers[0]."""
        node = (i + self.k) // 2
        while node > 0:
            held = self.losers[node]
            if held < 0:
                self.losers[node] = i  # waits for its opponent
                return
            if self._less(held, i):
                self.losers[node], i = i, held
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        for _ in range(sum(map(len, self.runs))):
            best = self.losers[0]
            yield self.runs[best][self.at[best]]
            self.at[best] += 1
            self._play(best)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by run and place in the run, about ROWS_PER_RANGE of them; the slices of the runs are held and merged."""
    slices: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(len(_ENTRY))), strict=True):
            slices.setdefault(row[9], []).append((sort_key(row), row))
    out = []
    for _, row in LoserTree(list(slices.values())) if slices else ():
        out.append(row)
        if len(out) == 5000:
            yield record_batch(_ENTRY, *map(list, zip(*out, strict=True)))
            out = []
    if out:
        yield record_batch(_ENTRY, *map(list, zip(*out, strict=True)))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    arrow_bounds(spark)
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    return staged(map_arrow(pieces, _runs, ENTRY), "runs")


def capture_histories(spark: SparkSession, path: str) -> DataFrame:
    """All captures in the archives, ordered by URL key, time and id over the partitions one after the other."""
    runs = read_runs(spark, path)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // ROWS_PER_RANGE))
    dealt = runs.repartitionByRange(ranges, "url_key", "captured", "page_id", "archive", "offset").sortWithinPartitions("run", "seq")
    return map_arrow(dealt, _merge, ENTRY).drop("run", "seq")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("payload"))
    return capture_histories(spark, write_archives(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
SELECT page_id, n AS payload_bytes, sha AS payload_digest, CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to
FROM (SELECT page_id, n, sha, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY sha) END AS kept
      FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS sha FROM pages))
"""
