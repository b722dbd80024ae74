"""WARC archives: pages are written as records and read back as a table of chunks.

Writing. Every page is one record. Of pages with equal payloads of at least
``revisit_min_bytes`` bytes, those with the smallest ``page_id`` are ``response``, the
others ``revisit`` without payload. A payload longer than ``segment_bytes`` becomes a
``response`` and ``continuation`` records (the standard's record segmentation), so no row
holds more than one segment. Files are written by Spark's text sink, whose line
separator is the two line ends that close a WARC record; it works on every file system
Spark can reach, and a failed task leaves nothing behind. Each file is one gzip stream.

Reading. A gzip file is read by one task from its start, in rows that end at each pair of line ends.
The parser puts these ends back and counts ``Content-Length`` bytes, so line ends in a payload,
also where it ends, are its own. It holds one such row and one chunk at a time, and
yields one row per chunk: record number, chunk number, and the digest and length of
the payload up to and with that chunk. The digest is carried on from chunk to chunk.
Own archives have no longer row than a segment; in others, a block without two line ends in a
row is one row of Spark's reader, whatever its length.

A url with white space or control characters is escaped in ``WARC-Target-URI`` and kept as it is in
a header of its own.

Defined cases: NULL html is an empty payload; NULL page_id and url are left out of the
headers and come back as NULL; a NULL page_id is larger than any other; rows that repeat
the smallest page_id of a payload are all ``response``; other columns are ignored; no
rows give no archive files and no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope.llm.common import gathered

RECORD_END = "\r\n\r\n"
_END = RECORD_END.encode()
_UNSAFE = r"[\x00-\x20\x7F-\x9F]"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
#: The standard's name for this kind of revisit (fixed value).
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNK_SCHEMA = pa.schema(
    [
        ("record_no", pa.int64()),
        ("chunk_no", pa.int64()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("last", pa.bool_()),
        ("data", pa.binary()),
    ]
)
CHUNK_DDL = (
    "record_no long, chunk_no long, record_type string, page_id long, url string, "
    "refers_to long, payload_bytes long, payload_digest string, last boolean, data binary"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1, from its hexadecimal form, five digits at a time."""
    digits = F.sha1(data)
    groups = [
        F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def with_roles(pages: DataFrame, revisit_min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, digest, first_id``; ``first_id`` is NULL for a response.

    One combined aggregate finds the first page of each payload; the join's two sides are
    plain shuffles, so a payload that a third of the pages share is split.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    pages = pages.withColumn("digest", base32_sha1(F.col("html")))
    first = pages.groupBy("digest").agg(F.min("page_id").alias("smallest"))
    revisit = (F.octet_length("html") >= revisit_min_bytes) & ~F.col("page_id").eqNullSafe(
        F.col("smallest")
    )
    return pages.join(first, "digest").select(
        "page_id", "url", "html", "digest", F.when(revisit, F.col("smallest")).alias("first_id")
    )


def records(pages: DataFrame, segment_bytes: int = 1 << 20, revisit_min_bytes: int = 0) -> DataFrame:
    """One row per WARC record, ``value`` holding its headers and block."""
    pages = with_roles(pages, revisit_min_bytes)
    is_revisit = F.col("first_id").isNotNull()
    size = F.octet_length("html")
    last = F.greatest(F.lit(0), F.ceil(size / segment_bytes).cast("int") - 1)
    pages = pages.withColumn("record_id", F.expr("uuid()")).withColumn(
        "segment", F.explode(F.sequence(F.lit(0), F.when(is_revisit, 0).otherwise(last)))
    )
    segment = F.col("segment")
    cut = F.col("html").cast("binary").substr(segment * segment_bytes + 1, F.lit(segment_bytes))
    whole = last == 0
    body = F.when(is_revisit, F.lit("")).when(whole, F.col("html")).otherwise(cut.cast("string"))
    head = F.when(segment == 0, F.lit(HTTP_HEAD + RECORD_END)).otherwise(F.lit(""))
    segmented = ~whole & ~is_revisit

    def line(name: str, value: Column | str) -> Column:
        """A header line, or nothing where the value is NULL."""
        value = F.lit(value) if isinstance(value, str) else value.cast("string")
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    own_id = F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))
    segment_id = F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))
    kind = F.when(is_revisit, "revisit").when(segment == 0, "response").otherwise("continuation")
    headers = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.when(segment == 0, own_id).otherwise(segment_id)),
        line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", F.regexp_replace("url", _UNSAFE, "%20")),
        line("X-Page-Url", F.when(F.col("url").rlike(_UNSAFE), F.base64(F.encode("url", "UTF-8")))),
        line("X-Page-Id", F.col("page_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", size),
        line("WARC-Profile", F.when(is_revisit, F.lit(REVISIT_PROFILE))),
        line("X-Refers-To-Page-Id", F.col("first_id")),
        line("WARC-Segment-Number", F.when(segmented, segment + 1)),
        line("WARC-Segment-Origin-ID", F.when(segmented & (segment > 0), own_id)),
        line(
            "WARC-Segment-Total-Length",
            F.when(segmented & (segment == last), size + len(HTTP_HEAD + RECORD_END)),
        ),
        line(
            "Content-Type",
            F.when(segment == 0, F.lit("application/http; msgtype=response")).otherwise(
                F.lit("application/octet-stream")
            ),
        ),
        F.lit("Content-Length: "),
        (F.octet_length(head) + F.octet_length(body)).cast("string"),
        F.lit(RECORD_END),
    )
    return pages.select(F.concat(headers, head, body).alias("value"))


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """Writes the pages' records as gzip-compressed WARC files under ``path``."""
    out = records(pages, **options).write.option("lineSep", RECORD_END)
    out.option("compression", "gzip").text(path)


class _Archive:
    """The bytes of an archive from the rows between its ``RECORD_END`` marks."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.rest = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.rest += piece + _END
        return piece is not None

    def at_end(self) -> bool:
        """Whether nothing but line ends is left."""
        while not self.rest.strip(b"\r\n"):
            self.rest = b""
            if not self._more():
                return True
        return False

    def head(self) -> bytes:
        """Up to the next ``RECORD_END``, which is passed over."""
        while (at := self.rest.find(_END)) < 0:
            if not self._more():
                raise ValueError("an archive ends within headers")
        out, self.rest = self.rest[:at], self.rest[at + len(_END) :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, as they come."""
        while n:
            if not self.rest and not self._more():
                raise ValueError("an archive ends within a block")
            out, self.rest = self.rest[:n], self.rest[n:]
            n -= len(out)
            yield out


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip(" \t") for k, _, v in (x.partition(":") for x in lines)}


def _cut(parts: Iterator[bytes], size: int) -> Iterator[bytes]:
    """The same bytes in chunks of ``size``, the last one shorter; one empty chunk for no bytes."""
    kept = bytearray()
    for part in parts:
        kept += part
        while len(kept) > size:
            yield bytes(kept[:size])
            del kept[:size]
    yield bytes(kept)


def _chunks(pieces: Iterator[bytes], chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    """One row per chunk of each record in a stream of pieces between ``RECORD_END``."""
    archive = _Archive(pieces)
    record_no, digest, length, chunk_no, first = -1, None, 0, 0, {}
    while not archive.at_end():
        here = _headers(archive.head())
        left = int(here["content-length"])
        if here.get("warc-type") != "continuation":
            record_no, digest, length, chunk_no, first = record_no + 1, hashlib.sha1(), 0, 0, here
        kind = first.get("warc-type")
        segmented = "warc-segment-number" in here
        ends = not segmented or "warc-segment-total-length" in here
        page, refers = first.get("x-page-id"), first.get("x-refers-to-page-id")
        target = first.get("warc-target-uri")
        if "x-page-url" in first:
            target = base64.b64decode(first["x-page-url"]).decode()
        if here is first and "application/http" in here.get("content-type", ""):
            left -= len(archive.head()) + len(_END)
            if left < 0:
                raise ValueError("HTTP headers are longer than their record")
        read = 0
        for data in _cut(archive.take(left), chunk_bytes):
            read += len(data)
            digest.update(data)
            length += len(data)
            last = ends and read == left
            size, sha1 = length, base64.b32encode(digest.digest()).decode()
            if kind == "revisit":
                size = int(first["x-payload-length"])
                sha1 = first["warc-payload-digest"].partition(":")[2]
            elif last and sha1 != first.get("warc-payload-digest", "").partition(":")[2]:
                raise ValueError(f"payload of record {first.get('warc-record-id')} is damaged")
            yield (
                record_no,
                chunk_no,
                kind,
                page and int(page),
                target,
                refers and int(refers),
                size,
                sha1,
                last,
                data if with_data else None,
            )
            chunk_no += 1
        if b"".join(archive.take(len(_END))) != _END:
            raise ValueError("a block is longer than its Content-Length")


def read_chunks(
    spark: SparkSession, path: str, chunk_bytes: int = 1 << 20, with_data: bool = True
) -> DataFrame:
    """The chunk table of the archives under ``path``, in file order."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (x.as_py() for b in batches for x in b.column(0))
        rows = _chunks(pieces, chunk_bytes, with_data)
        return gathered(rows, CHUNK_SCHEMA, 16 if with_data else 2048)

    lines = spark.read.option("lineSep", RECORD_END).schema("value string").text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(parse, CHUNK_DDL)


def record_digests(chunks: DataFrame) -> DataFrame:
    """One row per record: its last chunk carries the digest of the whole payload."""
    return chunks.where("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
