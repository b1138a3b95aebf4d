"""Web archives: records written and read back, and their index merged from sorted capture runs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veldcube.functions.session import broadcast_if_small
from veldcube.llm.common import numbered, partitions, shared_path, stored

#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 100
#: Revisit decisions up to so many rows are broadcast to the writers; more are joined by shuffle.
SMALL = 500_000
CRLF = "\r\n"
END = CRLF * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Captures, written once: row, page_id, url, payload (null html is empty) and a capture time,
    which is the page's number in seconds from a fixed day on."""
    seconds = F.lit(1_704_067_200) + F.coalesce(F.pmod(F.col(id_col), F.lit(1_000_000_000)), F.lit(0))
    return numbered(pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
        F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured")))


def revisits(pages: DataFrame) -> DataFrame:
    """Captures (row) whose payload an earlier page has, with that capture (first_row). Copies are
    reduced to a digest and the first page before anything is joined."""
    digests = stored(pages.select("row", "page_id", F.octet_length("payload").alias("bytes"), F.sha2("payload", 256).alias("digest")).filter(F.col("bytes") >= REVISIT_BYTES), "digests")
    first = digests.groupBy("digest", "bytes").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "row")).alias("first"), F.count("*").alias("n"))
    several = first.filter("n > 1").select("digest", F.col("first.row").alias("first_row"))
    return digests.join(several, "digest").filter("row != first_row").select("row", "first_row")


def _record_id(row: Column) -> Column:
    h = F.md5(F.concat(F.lit("capture:"), row.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """The text of every record; responses hold the payload, revisits refer to the response."""
    marked = pages.join(broadcast_if_small(repeated, SMALL), "row", "left")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    maybe = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    text = lambda c: F.col(c).cast("string")
    is_revisit = F.col("first_row").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("row"))), line("WARC-Date", F.col("captured")), maybe("WARC-Target-URI", uri),
        maybe("X-Page-ID", text("page_id")), line("X-Capture", text("row")),
        F.when(is_revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("first_row"))), maybe("X-Refers-To-Capture", text("first_row")))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.sha2("payload", 256))),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"), line("Content-Length", F.octet_length("block").cast("string")), F.lit(CRLF))
    return marked.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Write captures as WARC files, one per partition of `pages`; a record ends with an empty line."""
    records(pages, revisits(pages)).write.option("lineSep", END).text(path)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query; scheme, www and fragment do not count."""
    parts = urlsplit((url or "").strip(), allow_fragments=True) if url else None
    if not parts or not parts.netloc:
        return (url or "").lower()
    host, _, port = parts.netloc.rpartition("@")[2].lower().partition(":")
    host = re.sub(r"^www\d*\.", "", host)
    path = (parts.path or "/").lower() + (f"?{parts.query.lower()}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + path


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """Records of an archive file: offset, length, header fields and block. Lengths are those of the
    headers; a file that breaks off or holds anything else between records is an error."""
    at, whole = 0, memoryview(data)
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if head < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in data[at:head].decode().split(CRLF)[1:])
        start = head + 4
        stop = start + int(fields["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield at, stop + 4 - at, fields, whole[start:stop]
        at = stop + 4


INDEX = ("url_key string, captured string, capture long, page_id long, record_type string, payload_digest string, "
         "payload_bytes long, refers_capture long, file string, offset long, length long")


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index lines of every archive file, sorted by URL key, time and capture within the file; the
    digest and length are those of the payload that was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in INDEX.split(", ")]
        kinds = [pa.string() if x.endswith("string") else pa.int64() for x in INDEX.split(", ")]
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                lines = []
                for offset, length, fields, block in parse_records(content.as_py()):
                    cut = bytes(block[:1024]).find(b"\r\n\r\n") + 4
                    kind, payload = fields["WARC-Type"], block[cut:]
                    digest = sha256(payload).hexdigest() if kind == "response" else None
                    if digest and f"sha256:{digest}" != fields["WARC-Payload-Digest"]:
                        raise ValueError(f"{file.as_py()}: payload at byte {offset} has another digest than its header")
                    number = lambda name: int(fields[name]) if name in fields else None
                    lines.append((
                        url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], int(fields["X-Capture"]), number("X-Page-ID"), kind, digest,
                        len(payload) if digest else None, number("X-Refers-To-Capture"), file.as_py(), offset, length))
                lines.sort(key=lambda x: x[:3])
                columns = zip(*lines, strict=True) if lines else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, INDEX)


class LoserTree:
    """Merges sorted runs; the tree keeps the loser of every match, so a step replays one path."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.best = winners[1] if self.size > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.best] is not None:
            winner = self.best
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            node = (winner + self.size) // 2
            while node:
                if self._before(self.losers[node], winner):
                    winner, self.losers[node] = self.losers[node], winner
                node //= 2
            self.best = winner


def merged_index(runs: DataFrame) -> DataFrame:
    """The index in the order of URL key, time and capture, partition after partition.

    Ranges of the key are dealt to tasks, so that even one URL's history may spread over several; a task
    holds the slices of all runs in its range, as they were sorted, and merges them with a loser tree.
    """
    key = ["url_key", "captured", "capture"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        files, columns = table.column("file").to_pylist(), [table.column(c).to_pylist() for c in key]
        starts = [i for i in range(len(files)) if not i or files[i] != files[i - 1]]
        slices = [zip(*(c[a:b] for c in columns), range(a, b), strict=True) for a, b in zip(starts, [*starts[1:], len(files)], strict=True)]
        order = [x[-1] for x in LoserTree(slices)]
        yield from table.take(pa.array(order, pa.int64())).to_batches(max_chunksize=10_000)

    dealt = runs.repartitionByRange(partitions(runs.sparkSession), *key).sortWithinPartitions("file", *key)
    return dealt.mapInArrow(run, INDEX)


def archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write `pages` to WARC files at `path` (a new shared folder if none) and return their merged index,
    read back from the files.

    Of pages with equal payloads of REVISIT_BYTES or more, the one with the smallest page_id (null
    last, then the first row) is a response and the others are revisits of it. Null html is an empty
    payload, null urls have no target line and the first key. Pages may repeat; an empty table gives an
    empty index. Other columns are not read.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archive(captures(pages, id_col, url_col, html_col), path)
    runs = stored(capture_runs(spark, path), "capture-runs")
    return stored(merged_index(runs), "capture-index")


def histories(index: DataFrame) -> DataFrame:
    """The index with each capture's place in its URL's history."""
    return index.withColumn("place", F.row_number().over(W.partitionBy("url_key").orderBy("captured", "capture")))


def archive_report(pages: DataFrame) -> DataFrame:
    index = archive(pages)
    responses = index.filter("record_type = 'response'").select(
        F.col("capture").alias("refers_capture"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest"), F.col("page_id").alias("first_id"))
    return index.join(responses, "refers_capture", "left").select(
        "page_id", F.coalesce("payload_bytes", "bytes").alias("payload_bytes"), F.coalesce("payload_digest", "digest").alias("payload_digest"),
        "record_type", F.col("first_id").alias("refers_to"))


WARC_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select *, min(page_id) over (partition by payload_digest) as first_id from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id != first_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id != first_id then first_id end as refers_to
from f
"""
