"""Legacy web archives to WARC.

ARC files are parsed by the version their header block names: the version's URL-record line tells a record's
fields and its declared length, which is read exactly. Each record becomes an equivalent WARC record with
a synthesised id, timestamp, type and digests; payloads that occur again become revisit records. Archive
files are written and read by Spark, so they may lie in any store Spark reaches.

A file is one gzip stream of whole records. Files hold a bounded number of records, since a file is parsed
by one task.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import Workspace, table

RECORDS_PER_FILE = 1024
BATCH_BYTES = 8 << 20
GZIP_LEVEL = "THREE"  # as Hadoop names levels: about half the time of the default, files a few percent larger
MIN_REVISIT_BYTES = 0
KEY_FIELD = "X-Record-Key"
FIRST_KEY_FIELD = "X-First-Record-Key"
CAPTURE_DATE = "20240101000000"
SOFTWARE = "regain"

# The URL-record lines of the two ARC versions, field by field, and the WARC names they go by.
ARC_FIELDS = {
    "1": ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    "2": (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
WARC_END = "\r\n\r\n"  # after every record
ARC_END = "\n"


def safe_url(url: str | None) -> str:
    """The URL with blanks and control characters escaped, since a header line is split at blanks."""
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c.group()):02X}", url or "") or "-"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def http_head(key: object, size: int) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}"]
    if key is not None:
        lines.append(f"{KEY_FIELD}: {key}")
    return "\r\n".join(lines).encode() + CRLF + CRLF


def arc_opening(version: str, name: str, date: str) -> bytes:
    """The version block every ARC file begins with."""
    body = f"{version} 0 {SOFTWARE}\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(body), name) + body


def arc_line(version: str, url: str, ip: str, date: str, kind: str, length: int, name: str) -> bytes:
    fields = [url, ip, date, kind] + (["200", "-", "-", "0", name] if version == "2" else []) + [str(length)]
    return " ".join(fields).encode() + b"\n"


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html") -> None:
    """One ARC record per row, with HTTP headers; every other task writes the older version of the format."""
    rows = pages.select(
        F.col(key).cast("string"), F.col(url).cast("string"), F.coalesce(F.col(body).cast("binary"), F.lit(b"")).alias("body")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version = "12"[part % 2]
        out, written, size = [], 0, 0
        for batch in batches:
            for k, u, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if written % RECORDS_PER_FILE == 0:  # where the writer begins a file
                    name = f"part-{part:05d}-{written // RECORDS_PER_FILE:05d}.arc.gz"
                    out.append(arc_opening(version, name, CAPTURE_DATE))
                    written += 1
                content = http_head(k, len(payload)) + payload
                out.append(arc_line(version, safe_url(u), "0.0.0.0", CAPTURE_DATE, "text/html", len(content), name) + content)
                written += 1
                size += len(content)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    _write(rows.mapInArrow(build, "value binary"), path, ARC_END)


def _write(records: DataFrame, path: str, end: str) -> None:
    """Records as text files of whole records; the bytes go out as they are."""
    writer = records.select(F.col("value").cast("string")).write.option("lineSep", end).option("compression", "gzip")
    writer.option("zlib.compress.level", GZIP_LEVEL).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def _exactly(stream: BinaryIO, length: int, where: str) -> bytes:
    got = stream.read(length)
    if len(got) != length:
        raise ValueError(f"{where}: {length} bytes declared, {len(got)} there")
    return got


def read_arc(stream: BinaryIO, name: str) -> Iterator[dict]:
    """The records of one ARC file: its fields by name, ``offset`` and ``content``."""
    line = stream.readline()
    if not line:
        return
    opening = line.decode("utf-8", "replace").split()
    if not opening or not opening[0].startswith("filedesc://") or not opening[-1].isdigit():
        raise ValueError(f"{name}: no version block")
    offset = len(line) + int(opening[-1])
    block = _exactly(stream, int(opening[-1]), name).decode("utf-8", "replace").split("\n")
    version = block[0].split(" ")[0]
    if version not in ARC_FIELDS:
        raise ValueError(f"{name}: unknown version {version!r}")
    fields = ARC_FIELDS[version]
    while line := stream.readline():
        if line.strip():
            values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
            if len(values) != len(fields) or not values[-1].isdigit():
                raise ValueError(f"{name} at {offset}: not a version {version} header line")
            record = dict(zip(fields, values))
            length = int(record["Archive-length"])
            record |= {"version": version, "offset": offset, "content": _exactly(stream, length, f"{name} at {offset}")}
            offset += length
            yield record
        offset += len(line)


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """(status line and headers with the blank line, payload); no headers where it is no HTTP response."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    ends = [(content.find(mark) + len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if content.find(mark) >= 0]
    at = min(ends) if ends else len(content)
    return content[:at], content[at:]


def header(head: bytes, field: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(field.encode()) + rb":[ \t]*(.*?)[ \t]*\r?$", head)
    return found.group(1).decode("utf-8", "replace") if found else None


def warc_date(arc_date: str) -> str:
    """14 digits as a UTC timestamp; a shorter date is filled up with its earliest moment."""
    full = (arc_date + "00000101000000"[len(arc_date):])[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def converted(arc: DataFrame) -> DataFrame:
    """ARC files as one row per record, with the fields of its WARC record: ``key, record_id, date, url, ip, kind, head,
    payload, digest``. ``kind`` is response for HTTP content, else resource."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "record_id", "date", "url", "ip", "kind", "mime", "head", "payload", "digest"]
        types = [pa.string()] * 7 + [pa.binary(), pa.binary(), pa.string()]

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                name, rows, size = path.rsplit("/", 1)[-1], [], 0
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as stream:
                    for r in read_arc(stream, name):
                        head, payload = split_http(r["content"])
                        digest = digest32(payload)
                        identity = record_id(r["URL"], r["Archive-date"], digest, name, r["offset"])
                        rows.append((
                            header(head, KEY_FIELD), identity, warc_date(r["Archive-date"]), r["URL"], r["IP-address"],
                            "response" if head else "resource", r["Content-type"], head, payload, digest,
                        ))
                        size += len(payload)
                        if size >= BATCH_BYTES:
                            yield emit(rows)
                            rows, size = [], 0
                if rows:
                    yield emit(rows)

    return arc.mapInArrow(
        parse,
        "key string, record_id string, date string, url string, ip string, kind string, mime string, head binary,"
        " payload binary, digest string",
    )


def with_first(records: DataFrame, first: DataFrame) -> DataFrame:
    """Adds ``first_key, first_id, first_url, first_date`` of the record whose payload each one repeats."""
    return records.join(first, ["digest"], "left")


def first_records(narrow: DataFrame, min_bytes: int, key_type: str) -> DataFrame:
    """Per digest that occurs again, the HTTP response with the smallest key; NULL keys come last."""
    order = F.struct(F.col("key").isNull(), F.col("key").cast(key_type), "record_id", "url", "date")
    many = narrow.filter((F.col("kind") == "response") & (F.col("size") >= min_bytes))
    many = many.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("times")).filter("times > 1")
    return many.select(
        "digest", F.col("first.col2").cast("string").alias("first_key"), F.col("first.record_id").alias("first_id"),
        F.col("first.url").alias("first_url"), F.col("first.date").alias("first_date"),
    )


def warc_bytes(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None] + [f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + CRLF + CRLF + block


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of the converted records; a record that has a first one other than itself is a revisit."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, written, size = [], 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                if written % RECORDS_PER_FILE == 0:
                    info = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
                    fields = [
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo", r["record_id"])),
                        ("WARC-Date", r["date"]), ("Content-Type", "application/warc-fields"),
                    ]
                    out.append(warc_bytes(fields, info))
                    written += 1
                again = r["first_id"] is not None and r["first_id"] != r["record_id"] and r["kind"] == "response"
                block = r["head"] if again else r["head"] + r["payload"]
                fields = [
                    ("WARC-Type", "revisit" if again else r["kind"]), ("WARC-Record-ID", r["record_id"]),
                    ("WARC-Date", r["date"]), ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]),
                    ("WARC-Payload-Digest", f"sha1:{r['digest']}"), ("WARC-Block-Digest", f"sha1:{digest32(block)}"),
                    ("Content-Type", "application/http; msgtype=response" if r["head"] else r["mime"]),
                ]
                if again:
                    fields += [
                        ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", r["first_id"]),
                        ("WARC-Refers-To-Target-URI", r["first_url"]), ("WARC-Refers-To-Date", r["first_date"]),
                        (FIRST_KEY_FIELD, r["first_key"]),
                    ]
                out.append(warc_bytes(fields, block))
                written += 1
                size += len(block)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    wanted = records.select(
        "record_id", "date", "url", "ip", "kind", "mime", "head", "payload", "digest", "first_id", "first_key", "first_url",
        "first_date",
    )
    _write(wanted.mapInArrow(build, "value binary"), path, WARC_END)


def read_warc(stream: BinaryIO, name: str) -> Iterator[tuple[dict, bytes]]:
    """Header fields (with ``type``) and block of every record, by declared lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: not a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip()] = v.strip()
        yield fields, _exactly(stream, int(fields["Content-Length"]), name)


def warc_records(files: DataFrame, key: str, key_type: str) -> DataFrame:
    """One row per response, resource or revisit of the files: ``key, payload_bytes, payload_digest, record_type,
    refers_to``. A payload or block that its digest does not fit fails the job."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as stream:
                    for fields, block in read_warc(stream, path):
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        head, payload = split_http(block)
                        declared = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        fits = kind == "revisit" or digest32(payload) == declared
                        if not fits or digest32(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
                            raise ValueError(f"{path}: {fields['WARC-Record-ID']} does not fit its digest")
                        size = int(header(head, "Content-Length") or 0) if kind == "revisit" else len(payload)
                        rows.append((header(head, KEY_FIELD), size, declared, kind, fields.get(FIRST_KEY_FIELD)))
                if rows:
                    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    names = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = "key string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    rows = files.mapInArrow(parse, schema)
    return rows.select(
        F.col("key").cast(key_type).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(key_type).alias("refers_to"),
    )


def convert(spark: SparkSession, arc_path: str, warc_path: str, key_type: str = "bigint", min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write WARC files for the ARC files of a folder. Payloads of at least ``min_bytes`` that occur again are
    written once, with the record of the smallest key (read as ``key_type``); the others revisit it."""
    records = converted(archive_files(spark, arc_path))
    narrow = records.select("key", "record_id", "url", "date", "kind", "digest", F.octet_length("payload").alias("size"))
    write_warc(with_first(records, first_records(narrow, min_bytes, key_type)), warc_path)


def archive_pages(
    pages: DataFrame, work: Workspace, key: str = "page_id", url: str = "url", body: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Pages as ARC files, those as WARC files, and what the WARC files hold: ``key, payload_bytes, payload_digest,
    record_type, refers_to``, one row per page.

    NULL bodies are empty payloads; a NULL URL is written as ``-``; a NULL key is left out of the headers, comes last
    among equal payloads and reads back as NULL; rows repeated whole are records of their own; other columns
    are not read; an empty table gives empty files and no rows.
    """
    kind = pages.schema[key].dataType.simpleString()
    arc, warc = work.path(), work.path()
    write_arc(pages, arc, key, url, body)
    convert(work.spark, arc, warc, kind, min_bytes)
    work.delete(arc)
    return warc_records(archive_files(work.spark, warc), key, kind)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"), Workspace(spark, "op5"))


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i : ['0000','0001','0010','0011','0100','0101','0110','0111','1000',
    '1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', substr(hex, i, 1))]), '') AS bits,
    min(page_id) OVER (PARTITION BY body) AS first
  FROM p
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i : substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(1, 6), lambda j : CAST(substr(bits, CAST(5 * i + j AS BIGINT), 1) AS INTEGER) * CAST(pow(2, 5 - j) AS INTEGER)))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""
