"""WARC archives: writer, and sequential reader.

``write_archives`` turns rows into WARC 1.1 records, one gzip member each, in
files of about ``archive_bytes`` in a shared folder.  ``read_archives`` reads
each file once from front to back in small chunks: incremental zlib
decompression, the member's end as the record's end, Content-Length framing,
and SHA-1 verification of block and payload.

Each writing task gives its files new names and reports them in a manifest;
files of tasks that were lost or ran twice are in no manifest and not read.
Folders may be local (shared), hdfs://, s3:// or gs://.

Edge cases: a null payload is an empty one; a null url gives a record
without a target; a null page_id is written as such and read back as null;
of repeated rows with the largest page_id one is the response; an empty
table gives no archive; a record cut short or with a wrong digest is
returned with ``verified`` false.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import numbered
from marketlens.session import ensure_checkpoint_dir
from marketlens.sources.sinks import materialize

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
RECORD_DATE = "2024-01-01T00:00:00Z"
ID_PREFIX = "urn:marketlens:page:"

# fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:|/", uri):
        return fs.LocalFileSystem(), re.sub(r"^(file:)?/+", "/", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(record_type: str, record_id: str, url: str | None, payload: bytes, digest: str,
                 length: int, refers_to: str | None) -> bytes:
    """One uncompressed record; a revisit has the HTTP headers alone."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n").encode()
    if record_type == "response":
        block += payload
    head = [("WARC-Type", record_type), ("WARC-Record-ID", f"<{ID_PREFIX}{record_id}>"), ("WARC-Date", RECORD_DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>")]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_MANIFEST = "path string, records long, bytes long"


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    files, root = _filesystem(folder)
    out, path, records, written = None, "", 0, 0

    def done() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([records], pa.int64()),
                                           "bytes": pa.array([written], pa.int64())})

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            page, url, payload, digest, length, refers_to = row
            if out is None:
                path, records, written = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                out = files.open_output_stream(path, compression=None)
            member = _gzip(record_bytes("response" if refers_to is None else "revisit", str(page), url,
                                        payload or b"", digest, length, refers_to))
            out.write(member)
            records, written = records + 1, written + len(member)
            if written >= archive_bytes:
                yield done()
                out = None
    if out is not None:
        yield done()


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, refers_to.  Of equal
    payloads of ``least_bytes`` at least, the row with the largest page_id is
    the response (refers_to null) and the others name it."""
    payload = F.coalesce("doc.html", F.lit("")).cast("binary")
    rows = numbered(pages).select("doc.page_id", "doc.url", payload.alias("payload"),
                                  F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("sha1"), "row")
    order = F.struct(F.col("page_id").isNotNull().alias("known"), F.col("page_id"), F.col("row"))
    shared = (rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1")
              .agg(F.max(order).alias("top"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
              .select("sha1", F.col("top.row").alias("top_row"), F.coalesce(F.col("top.page_id").cast("string"), F.lit("None")).alias("top_id")))
    shared = materialize(shared)
    other = F.col("top_row").isNotNull() & (F.col("top_row") != F.col("row"))
    return (rows.join(shared, "sha1", "left")
            .select("page_id", "url", F.when(~other, F.col("payload")).alias("payload"), "sha1", "payload_bytes",
                    F.when(other, F.col("top_id")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of (page_id, url, html) and return the
    manifest (path, records, bytes), a stored table."""
    @F.arrow_udf("string")
    def base32(hexes: pa.Array) -> pa.Array:
        return pa.array([base64.b32encode(bytes.fromhex(h)).decode() for h in hexes.to_pylist()], pa.string())

    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    rows = with_roles(pages, least_bytes).select("page_id", "url", "payload", base32("sha1").alias("digest"), "payload_bytes", "refers_to")
    return materialize(rows.mapInArrow(lambda batches: _write(batches, folder, archive_bytes), _MANIFEST))


def members(stream: BinaryIO) -> Iterator[tuple[bytes, bool]]:
    """The decompressed gzip members of a stream and whether each is complete."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        chunk = rest or stream.read(READ_BYTES)
        if not chunk:
            break
        try:
            parts.append(unpack.decompress(chunk))
        except zlib.error:
            yield b"".join(parts), False
            return
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts), True
            unpack, parts = zlib.decompressobj(31), []
    if parts:
        yield b"".join(parts), False


def parse_record(data: bytes, complete: bool) -> dict:
    """Fields of one record; ``verified`` if framing and digests hold."""
    head, gap, body = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else -1
    block = body[:max(length, 0)]
    framed = complete and bool(gap) and lines[0] == VERSION and length >= 0 and body[length:] == b"\r\n\r\n"
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    whole = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    full = int(whole[1]) if whole else len(payload)
    right = framed and fields.get("warc-block-digest", "").removeprefix("sha1:") == sha1_base32(block)
    if kind == "response":
        right = right and digest == sha1_base32(payload) and full == len(payload)
    name = lambda k: (m := re.fullmatch(rf"<{ID_PREFIX}(.*)>", fields.get(k, ""))) and m[1]
    return {"record_id": name("warc-record-id"), "record_type": kind, "url": fields.get("warc-target-uri"),
            "payload": payload if kind == "response" else None, "payload_bytes": full, "payload_digest": digest,
            "refers_to": name("warc-refers-to"), "verified": right}


_RECORD = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("verified", pa.bool_())])
_RECORD_DDL = ("record_id string, record_type string, url string, payload binary, payload_bytes long, "
               "payload_digest string, refers_to string, verified boolean")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, _ = _filesystem(folder)
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows, held = [], 0
            with files.open_input_stream(path, compression=None) as stream:
                for data, complete in members(stream):
                    rows.append(parse_record(data, complete))
                    held += len(data)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the manifest's archives, files spread over the tasks."""
    paths = manifest.select("path")
    return (paths.repartition(max(1, paths.count()), "path")
            .mapInArrow(lambda batches: _read(batches, folder), _RECORD_DDL))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages below the shared folder, read the archives back."""
    root = ensure_checkpoint_dir(pages.sparkSession)
    folder = f"{root.rstrip('/')}/marketlens-warc/{uuid.uuid4().hex}"
    found = read_archives(write_archives(pages, folder, least_bytes), folder)
    number = lambda c: F.expr(f"try_cast({c} as bigint)")
    return found.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        number("refers_to").alias("refers_to"), "verified")
