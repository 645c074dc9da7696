"""WARC archives: one gzip member per record, written and read sequentially.

Writer: every row becomes one record in a gzip member of its own.  Equal
payloads of at least ``min_revisit_bytes`` are stored once, as the response of
the largest page_id; the other rows become revisit records that name it.  Only
digests are grouped; a smaller payload meets no join.  A file holds as many
records as make about ``FILE_BYTES`` of payload at the mean size.  The
members leave through Spark's text sink, which commits task output as any
Spark write does, on any file system: its line separator is one zero byte,
which replaces the last byte of a member (the top byte of gzip's length field,
zero below 16 MB) or pads after it, which gzip allows.

Reader: takes archive bytes in chunks, inflates member after member, frames a
record by its content length and verifies the digests it carries.  Beside the
compressed file that Spark hands to the task, memory is a chunk and a header,
whatever the record's length.  Records of other kinds (warcinfo, request,
metadata) are framed, verified and passed over.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import read_table, shared_path, ship_package, stored

CRLF = b"\r\n"
GZIP = 31
CHUNK = 1 << 16
FILE_BYTES = 64 << 20
PAGES = ("response", "revisit")
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:churnlens:warc")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# One archived page as the reader gives it.
PAGE_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long")


def base32_of(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def hex_of(labelled: str) -> str:
    return base64.b32decode(labelled.removeprefix("sha1:")).hex()


def record_id(page_id: int | None, digest: str, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}|{digest}|{url}')}>"


def header_value(text: str) -> str:
    """A header value on one line; other controls are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           refers_url: str | None, date: str) -> bytes:
    """One WARC record, uncompressed; a revisit of page ``refers_to`` at ``refers_url`` if the former is given."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + CRLF + CRLF)
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, digest, url)), ("WARC-Date", date),
              ("WARC-Payload-Digest", base32_of(digest)),
              ("WARC-Block-Digest", base32_of(hashlib.sha1(block).hexdigest())),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, refers_url)),
                   ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-Id", str(refers_to))]
        if refers_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", header_value(refers_url)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    return head.encode("utf-8", "surrogatepass") + CRLF + block + CRLF + CRLF


def member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member without its last byte if that is zero (the sink adds it)."""
    z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    out = z.compress(raw) + z.flush()
    return out[:-1] if out[-1] == 0 else out


@dataclass
class Record:
    """Headers, HTTP headers, payload length and digest of one record."""

    headers: dict[str, str]
    http: dict[str, str] = field(default_factory=dict)
    payload_bytes: int = 0
    payload_digest: str = ""
    payload: bytes | None = None


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


class _Framer:
    """Frames and verifies the one record of a member from inflated pieces."""

    def __init__(self, keep: bool):
        self.keep, self.state, self.buffer = keep, "head", b""
        self.block, self.payload, self.kept = hashlib.sha1(), hashlib.sha1(), []
        self.record: Record | None = None
        self.left, self.tail = 0, b""

    def feed(self, data: bytes) -> None:
        if self.state == "head":
            self.buffer += data
            head, end, data = self.buffer.partition(CRLF + CRLF)
            if not end:
                return
            if not head.startswith(b"WARC/1."):
                raise ValueError("a member does not start with a WARC header")
            self.record, self.buffer = Record(fields_of(head)), b""
            http = self.record.headers.get("content-type", "").startswith("application/http")
            self.state = "http" if http else "payload"
            self.left = int(self.record.headers["content-length"])
        if self.state in ("http", "payload"):
            block, data = data[:self.left], data[self.left:]
            self.left -= len(block)
            self.block.update(block)
            if self.state == "http":
                self.buffer += block
                head, end, block = self.buffer.partition(CRLF + CRLF)
                if end:
                    self.record.http, self.buffer, self.state = fields_of(head), b"", "payload"
            if self.state == "payload":
                self.payload.update(block)
                self.record.payload_bytes += len(block)
                if self.keep:
                    self.kept.append(block)
            if self.left == 0:
                self.state = "tail"
        if self.state == "tail":
            self.tail += data

    def done(self) -> Record:
        if self.state != "tail" or self.left or self.tail != CRLF + CRLF:
            raise ValueError("a record is shorter or longer than its content length")
        r = self.record
        stated = {k: hex_of(v) for k in ("warc-block-digest", "warc-payload-digest")
                  if (v := r.headers.get(k, "")).startswith("sha1:")}
        if stated.get("warc-block-digest", self.block.hexdigest()) != self.block.hexdigest():
            raise ValueError(f"block digest differs in {r.headers.get('warc-record-id')}")
        r.payload_digest = stated.get("warc-payload-digest", self.payload.hexdigest())
        length = r.http.get("content-length")
        if r.headers.get("warc-type") != "revisit":
            if r.payload_digest != self.payload.hexdigest() or (length is not None and r.payload_bytes != int(length)):
                raise ValueError(f"payload differs in {r.headers.get('warc-record-id')}")
        elif length is not None:
            r.payload_bytes = int(length)
        r.payload = b"".join(self.kept) if self.keep else None
        return r


def chunks_of(content: bytes) -> Iterator[memoryview]:
    view = memoryview(content)
    for at in range(0, len(view), CHUNK):
        yield view[at:at + CHUNK]


def read_archive(chunks: Iterable[bytes], keep_payload: bool = False) -> Iterator[Record]:
    """Records of one archive in order; raises on damage or truncation."""
    inflate, framer = None, None
    for chunk in chunks:
        data = bytes(chunk)
        while data:
            if inflate is None:
                data = data.lstrip(b"\0")  # padding between members
                if not data:
                    break
                inflate, framer = zlib.decompressobj(GZIP), _Framer(keep_payload)
            piece = inflate.decompress(data, CHUNK)
            framer.feed(piece)
            if inflate.eof:
                yield framer.done()
                data, inflate = inflate.unused_data, None
            else:
                data = inflate.unconsumed_tail
    if inflate is not None:
        raise ValueError("the archive ends inside a member")


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 1000,
                   date: str = "2026-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``path``.

    A null html is an empty payload; a null url or page_id leaves its header
    out.  A row without page_id can refer but is never referred to.  Rows that
    share the largest page_id of a group are all responses; the largest url
    among them is named.
    """
    ship_package(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).select(
        "page_id", "url", "payload", F.sha1("payload").alias("digest"))
    large = F.octet_length("payload") >= min_revisit_bytes
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("bytes")).first()
    per_file = max(1, int(file_bytes * size.n // max(size.bytes or 0, 1))) if size.n else 1
    shared = (rows.where(large).groupBy("digest")
              .agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n"))
              .where("n > 1 and last.page_id is not null").select("digest", "last"))
    shared = stored(shared, "warc-shared")  # only digests that occur again
    revisit = ~F.col("page_id").eqNullSafe(F.col("last.page_id"))
    again = rows.where(large).join(shared, "digest", "left").withColumns({
        "refers_to": F.when(revisit, F.col("last.page_id")), "refers_url": F.when(revisit, F.col("last.url"))}).drop("last")
    alone = rows.where(~large).withColumns({"refers_to": F.lit(None).cast(again.schema["refers_to"].dataType),
                                            "refers_url": F.lit(None).cast("string")})
    rows = alone.unionByName(again)

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"member": [
                member(record(None if pd.isna(i) else int(i), u, p, d, None if pd.isna(r) else int(r), v, date))
                for i, u, p, d, r, v in zip(b["page_id"], b["url"], b["payload"], b["digest"], b["refers_to"], b["refers_url"])]})

    ids = ["page_id", "refers_to"]  # as text: a null must not turn other ids into floats
    packed = (rows.select(*[F.col(c).cast("string").alias(c) for c in ids], "url", "payload", "digest",
                          "refers_url").mapInPandas(members, "member binary"))
    (packed.select(F.col("member").cast("string").alias("value")).write
     .option("lineSep", "\0").option("maxRecordsPerFile", per_file).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every response and revisit."""
    ship_package(spark)

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = [(number(r.headers.get("x-page-id")), r.headers.get("warc-target-uri"), r.payload_bytes,
                         r.payload_digest, r.headers["warc-type"], number(r.headers.get("x-refers-to-page-id")))
                        for r in read_archive(chunks_of(content)) if r.headers.get("warc-type") in PAGES]
                out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type",
                                                  "refers_to"])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(records, PAGE_SCHEMA)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every row of ``pages`` and read the archives back."""
    path = shared_path(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).drop("url")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM m
"""
