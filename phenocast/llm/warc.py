"""WARC archives: writer, and sequential reader with digest verification (operator 2).

An archive is a series of records, each a gzip member of its own.  Archives are kept
as a table (archive, data), a row an archive: a Spark writer puts them where the
inputs are, whatever the store, and a lost task is simply run again.  ``write``
starts a new archive every ``archive_bytes``; ``read`` streams each archive in pieces
through one reader, in the task that holds it, and inflates one record at a time.
``read_files`` reads ``.warc.gz`` files of any path that Spark can list.

Among records with equal payloads (same SHA-1 and length) of at least
``least_bytes`` the one with the largest id is a ``response``; the others are
``revisit`` records that refer to it and carry no payload.  Smaller ones are all
responses.

The reader checks, and raises ValueError otherwise: one record a member, the WARC
version line, content-length framing with the closing empty lines, block digest,
and for responses the payload's length and digest.

Defined results: a null payload is empty; a null or empty url gives a record without
target; control and blank characters in a url are percent-encoded; repeated rows
get equal records, and all rows with their group's largest id are responses; a null
id is smaller than any other, and rows of a group that has null ids only are
responses; an empty table gives no archive; other columns are passed by.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.llm._common import table, utf8, written
from phenocast.llm.simhash import join_back

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PAGES = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(url: str | None) -> str | None:
    return re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False,
           level: int = 6) -> bytes:
    """One gzip member with a response record, or a revisit record of ``refers_to``."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>")]
    if uri := _uri(url):
        fields.append(("WARC-Target-URI", uri))
    fields.append(("WARC-Date", "1970-01-01T00:00:00Z"))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + z.flush()


# --- reading ---------------------------------------------------------------------------------

class _Member:
    """Framing of the record in one gzip member, fed with pieces of its plain bytes."""

    def __init__(self):
        self.head, self.body, self.fields, self.size, self.tail = bytearray(), bytearray(), None, 0, b""
        self.sha1 = hashlib.sha1()

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                return
            data = bytes(self.head[end + 4:])
            lines = self.head[:end].decode("utf-8", "surrogatepass").split("\r\n")
            if not re.fullmatch(r"WARC/1\.\d", lines[0]):
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            self.size = int(self.fields["content-length"])
        want = self.size - len(self.body)
        part = data[:want]
        self.body += part
        self.sha1.update(part)
        self.tail += data[len(part):]
        if len(self.tail) > 4:
            raise ValueError("bytes behind the record's content length")

    def done(self) -> tuple[dict, bytes]:
        if self.fields is None or len(self.body) != self.size or self.tail != b"\r\n\r\n":
            raise ValueError("record ends before its content length and closing lines")
        said = self.fields.get("warc-block-digest")
        if said and said.partition(":")[2] != base64.b32encode(self.sha1.digest()).decode():
            raise ValueError("block digest does not hold")
        return self.fields, bytes(self.body)


def read_records(chunks: Iterable[bytes], piece: int = 1 << 16) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record, from an archive's bytes in order."""
    z, member = None, None
    for chunk in chunks:
        data = chunk
        while data:
            if z is None:
                z, member = zlib.decompressobj(31), _Member()
            out = z.decompress(data, piece)
            if out:
                member.feed(out)
            data = z.unconsumed_tail
            if z.eof:
                yield member.done()
                data, z = z.unused_data, None
    if z is not None:
        raise ValueError("the archive ends within a record")


def parse(fields: dict, block: bytes) -> tuple[int | None, int, str, str, int | None, bytes | None]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload), verified."""
    kind = fields["warc-type"]
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)[1])
    said = fields["warc-payload-digest"].partition(":")[2]
    page = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
    if kind == "response":
        if len(payload) != size or digest(payload) != said:
            raise ValueError(f"payload digest of page {page} does not hold")
        return int(page) if page else None, size, said, kind, None, payload
    refers = int(fields["warc-refers-to"].removeprefix("<urn:page:").removesuffix(">"))
    return int(page) if page else None, size, said, kind, refers, None


# --- on Spark --------------------------------------------------------------------------------

def mark_revisits(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """(page_id, digest, bytes, first): ``first`` is the id that a row's group refers to,
    null where it is smaller than ``least_bytes``.  Only digests are shuffled; a hot
    digest is combined first and joined by broadcast."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.sha1(payload).alias("digest"),
                        F.octet_length(payload).cast("bigint").alias("bytes"))
    rows = written(rows, "warc-digests")
    first = rows.groupBy("digest").agg(F.max("page_id").alias("first"), F.max("bytes").alias("b"))
    first = first.select("digest", F.when(F.col("b") >= least_bytes, F.col("first")).alias("first"))
    return join_back(rows, first, "digest")


def write(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = 1 << 23, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html") -> DataFrame:
    """Archives with a record per page, written in the shared folder: a table
    (archive, data).  An archive is closed by the record that reaches ``archive_bytes``."""
    marks = mark_revisits(pages, least_bytes, id_col, payload_col)
    # pages that are revisits, with what they refer to; all others are responses
    revisits = (marks.where("first IS NOT NULL AND (page_id IS NULL OR page_id < first)")
                .select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), F.col("first").alias("__first")).distinct())
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    rows = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    rows = rows.select("page_id", "url", "payload", F.col("__first").alias("first"))

    def run(batches):
        part, k, buf = TaskContext.get().partitionId(), 0, bytearray()

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{k:05d}.warc.gz"]), pa.array([bytes(buf)], pa.binary())], names=["archive", "data"])

        for batch in batches:
            for page, url, data, first in zip(*batch.columns):
                data, first = data.as_py(), first.as_py()
                buf += record(page.as_py(), url.as_py(), data, first, first is not None)
                if len(buf) >= archive_bytes:
                    yield archive()
                    k, buf = k + 1, bytearray()
        if buf:
            yield archive()

    return written(rows.mapInArrow(run, "archive string, data binary"), "warc-archives")


def _pages(records: Iterator[tuple[dict, bytes]], with_payload: bool, rows: int = 500):
    held: list = []
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload

    def pack():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], t) for i, t in enumerate(kinds)], names=names)

    size = 0
    for fields, block in records:
        if fields["warc-type"] in ("response", "revisit"):
            held.append(parse(fields, block))
            size += len(block) if with_payload else 0
        if len(held) >= rows or size >= 1 << 24:
            yield pack()
            held, size = [], 0
    if held:
        yield pack()


def _stream(batches, with_payload: bool, piece: int = 1 << 16):
    for batch in batches:
        for data in batch.column(0):
            data = memoryview(data.as_buffer())
            yield from _pages(read_records(bytes(data[i:i + piece]) for i in range(0, len(data), piece)), with_payload)


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per response and revisit record of an archive table (see ``write``)."""
    return archives.select("data").mapInArrow(lambda b: _stream(b, with_payload), PAGES + (", payload binary" if with_payload else ""))


def read_files(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The same of ``.warc.gz`` files (each under 2 GB) under a path of any store."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(path)
    return read(files.select(F.col("path").alias("archive"), F.col("content").alias("data")), with_payload)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(write(table(spark, sf_dir, "pages")))


OP2_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{_ALPHABET}',
           CAST(1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""
