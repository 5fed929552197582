"""WARC archives: writing, reading back, and revisit resolution.

A record is text: header lines, a blank line and an HTTP response, whose body is
the payload; a revisit has the HTTP head only.  Spark's text writer puts the record
separator (two line ends) after each, so every part file is a WARC archive,
packed as one gzip stream.  Reading goes by Content-Length, so payloads may hold
anything, the separator included.  An archive has a bounded number of records and
of bytes, as one task reads it whole.

Revisit resolution shuffles narrow headers by payload digest, takes the
smallest record id as the original, and joins the others to it.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import need_columns, shared_folder

MIN_PAYLOAD = 100
# The pages have no time of their capture, so one is given, and reruns agree.
DATE = "2024-01-01T00:00:00Z"
# Records and payload bytes of one archive; a longer payload has one of its own.
ARCHIVE_RECORDS = 1000
ARCHIVE_BYTES = 1 << 28
LINE = "\r\n"

RECORD = (
    "record_id long, record_type string, uri string, refers_to long, "
    "payload_digest string, payload_bytes long, payload string"
)


def payload_headers(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest of every row; a null html is empty."""
    need_columns(pages, "page_id", "html")
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
    )


def resolve_revisits(headers: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Adds record_type and refers_to to (page_id, payload_bytes, payload_digest).

    The smallest id per digest is found by partial minima, then joined back, so
    a digest of many records is split over tasks.  A null id is a response.
    """
    large = headers.where(F.col("payload_bytes") >= min_payload)
    first = large.groupBy("payload_digest").agg(
        F.min("page_id").alias("original"), F.count("*").alias("records")
    )
    first = first.where("records > 1").select("payload_digest", "original")
    joined = headers.join(first, "payload_digest", "left")
    revisit = (F.col("original") < F.col("page_id")) & (F.col("payload_bytes") >= min_payload)
    revisit = F.coalesce(revisit, F.lit(False))
    return joined.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("original")).alias("refers_to"),
    )


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(LINE))


def _urn(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(record_id.cast("string"), F.lit("none")), F.lit(">"))


def record_text(date: str = DATE) -> Column:
    """A record of columns page_id, url, html, record_type, refers_to, payload_digest.

    Line ends and other control characters of a URL are percent-encoded, so
    they cannot forge a header.
    """
    url = F.coalesce("url", F.lit(""))
    for code in (37, *range(32), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    revisit = F.col("record_type") == "revisit"
    payload = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}"),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(payload).cast("string")),
        F.lit(LINE),
    )
    body = F.when(revisit, head).otherwise(F.concat(head, payload))
    reference = F.concat(
        _line("WARC-Refers-To", _urn(F.col("refers_to"))),
        _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
    )
    return F.concat(
        F.lit(f"WARC/1.1{LINE}"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, reference).otherwise(""),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(LINE),
        body,
    )


def write_archives(records: DataFrame, path: str, pages: DataFrame | None = None) -> None:
    """Write (page_id, url, html, record_type, refers_to, payload_digest) rows as archives.

    ``pages`` is a table cheaper to read than ``records`` with the same html.
    """
    longest = (records if pages is None else pages).agg(F.max(F.octet_length("html"))).first()[0] or 1
    limit = max(1, min(ARCHIVE_RECORDS, ARCHIVE_BYTES // max(1, longest)))
    (
        records.select(record_text().alias("record"))
        .write.option("lineSep", LINE * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", limit)
        .text(path)
    )


def _records(data: bytes) -> Iterator[tuple]:
    """Record id, type, uri, reference, digest and payload bytes of each record."""
    inflate = zlib.decompressobj(wbits=31)
    stream = io.BufferedReader(_Inflated(inflate, data), 1 << 16)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        payload = block[block.index(b"\r\n\r\n") + 4 :]  # after the HTTP head
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield (
            head["WARC-Record-ID"],
            head["WARC-Type"],
            head["WARC-Target-URI"],
            head.get("WARC-Refers-To"),
            head["WARC-Payload-Digest"].partition(":")[2],
            payload,
        )


class _Inflated(io.RawIOBase):
    """Bytes of a gzip file, unpacked piece by piece."""

    def __init__(self, inflate, data: bytes) -> None:
        self.inflate, self.rest = inflate, data

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while self.rest and not self.inflate.eof:
            out = self.inflate.decompress(self.rest, len(into))
            self.rest = self.inflate.unconsumed_tail
            if out:
                into[: len(out)] = out
                return len(out)
        return 0


def _number(urn: str | None) -> int | None:
    if urn is None or urn == "<urn:page:none>":
        return None
    return int(urn.removeprefix("<urn:page:").removesuffix(">"))


def _percent_decoded(uri: str) -> str:
    from urllib.parse import unquote

    return unquote(uri) if "%" in uri else uri


def _parse(with_payload: bool):
    schema = pa.schema(
        [
            ("record_id", pa.int64()),
            ("record_type", pa.string()),
            ("uri", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for urn, kind, uri, reference, digest, payload in _records(content.as_py()):
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{urn}: the payload does not match its digest")
                    text = payload.decode() if with_payload and kind == "response" else None
                    length = len(payload) if kind == "response" else None
                    rows.append(
                        (_number(urn), kind, _percent_decoded(uri), _number(reference), digest, length, text)
                    )
                    size += len(payload)
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema
                        )
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema
                    )

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``; digests of responses are checked.

    A revisit has no payload of its own: payload and payload_bytes are null.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_parse(with_payload), RECORD)


def follow_revisits(records: DataFrame) -> DataFrame:
    """Every record with the payload length of the response it stands for."""
    own = records.select("record_id", "record_type", "refers_to", "payload_digest", "payload_bytes")
    origin = own.where("record_type = 'response'").select(
        F.col("record_id").alias("origin"),
        F.col("payload_digest").alias("origin_digest"),
        F.col("payload_bytes").alias("origin_bytes"),
    )
    origin = origin.where("origin IS NOT NULL").distinct()
    match = F.expr("refers_to = origin AND payload_digest = origin_digest")
    return own.join(origin, match, "left").select(
        F.col("record_id").alias("page_id"),
        F.coalesce("payload_bytes", "origin_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


def deduplicated_archives(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as deduplicated archives and read them back.

    Rows that repeat a page_id and payload are one response each; revisits refer
    to it once.  Null urls become empty, other columns are ignored.
    """
    need_columns(pages, "page_id", "url", "html")
    decided = resolve_revisits(payload_headers(pages), min_payload)
    kinds = decided.select("page_id", "payload_digest", "record_type", "refers_to").distinct()
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("payload_digest"),
    )
    match = rows.page_id.eqNullSafe(kinds.page_id) & (rows.payload_digest == kinds.payload_digest)
    records = rows.join(kinds, match).select(
        rows.page_id, "url", "html", rows.payload_digest, "record_type", "refers_to"
    )
    write_archives(records, path, pages)
    return follow_revisits(read_archives(pages.sparkSession, path, with_payload=False))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Read back from archives written below the shared folder.  A null html is an
    empty payload, a null url an empty one; a null page_id is a response.  Rows that
    repeat a page_id and payload are one response each, and of equal payloads the
    smallest page_id is the one referred to, so there are no ties.  Long payloads
    are kept whole.  Other columns are ignored; no rows give no rows.
    """
    return deduplicated_archives(pages, shared_folder(pages.sparkSession))
