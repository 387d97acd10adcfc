"""WARC archives with an index: written record by record, read back by coalesced byte ranges.

Each record is its own gzip member, so a record can be read from (offset, length) alone. Writing returns
the index: file, offset, length, URL and digest of every record. Reading starts from a selection of index
rows, sorts them by file and offset, joins ranges that lie close together, and fetches each joined range
with one read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize, new_path
from . import files
from .common import parts, pieces

#: A file is closed once it holds so many bytes.
FILE_BYTES = 64 << 20
#: Records of a file are read by one task per so many bytes of it.
STRETCH_BYTES = 8 << 20
#: Ranges at most so far apart are fetched together ...
GAP_BYTES = 64 << 10
#: ... as long as one fetch takes no more than this (a single larger record is fetched alone).
FETCH_BYTES = 4 << 20

INDEX = (
    "file string, offset long, length long, url string, digest string, page_id long, record_type string, "
    "payload_bytes long, refers_to long"
)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record. A revisit keeps the HTTP header, with the payload's full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_name(page_id)}>", "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_name(refers_to)}>", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (x.split(": ", 1) for x in lines.decode().split("\r\n")[1:] if ": " in x)
    return {k.lower(): v for k, v in pairs}


def parse(content: bytes) -> dict:
    """The record's fields; the payload's digest and length are checked against what it holds."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("a payload differs from its record's header")

    def page(address: str | None):
        number = (address or "").strip("<>").removeprefix("urn:page:")
        return int(number) if number else None

    return {
        "page_id": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": page(fields.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
    }


def with_first(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Adds ``refers_to``: the smallest page_id with the same payload, where that is another page.

    Payloads below ``smallest`` bytes are not compared. The smallest page_id of each payload is found by
    an aggregation that sends one row per task and payload, however many copies there are; the join back
    has that small side as its hash table, and adaptive execution splits a payload's many pages.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_key", F.concat(F.sha1(F.col("html").cast("binary")), F.octet_length("html").cast("string")))
    firsts = (
        pages.select(F.coalesce("html", F.lit("")).alias("html"), "page_id")
        .filter((F.octet_length("html") >= smallest) & F.col("page_id").isNotNull())
        .groupBy(F.concat(F.sha1(F.col("html").cast("binary")), F.octet_length("html").cast("string")).alias("_key"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1").drop("_copies")
    )
    other = F.col("page_id").isNull() | (F.col("_first") != F.col("page_id"))
    return (
        rows.join(firsts.hint("shuffle_hash"), "_key", "left")
        .select("page_id", "url", "html", F.when(other, F.col("_first")).alias("refers_to"))
    )


def write(pages: DataFrame, folder: str, smallest: int = 0) -> DataFrame:
    """One record per row of ``pages`` (page_id, url, html); returns the index.

    Null html is an empty payload, a null url leaves the header out, a null page_id is nobody's
    reference. Rows equal in page_id and payload are all responses if they hold the smallest page_id. An
    empty table has no files. Only the three columns are read.
    """
    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = stream = None
        rows: list[dict] = []

        def close():
            stream.close()
            return pa.RecordBatch.from_pylist(rows, schema=_INDEX_SCHEMA)

        for piece in pieces(batches, "html", 1 << 20):
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in piece.columns)):
                if stream is None:
                    path, stream = files.open_new(folder, ".warc.gz")
                payload = html.encode()
                digest = base32_sha1(payload)
                member = gzip.compress(record(page_id, url, payload, digest, refers_to), 5, mtime=0)
                offset = stream.tell()
                stream.write(member)
                rows.append({
                    "file": path, "offset": offset, "length": len(member), "url": url, "digest": digest,
                    "page_id": page_id, "record_type": "response" if refers_to is None else "revisit",
                    "payload_bytes": len(payload), "refers_to": refers_to,
                })
                if stream.tell() >= FILE_BYTES:
                    yield close()
                    stream, rows = None, []
        if stream is not None:
            yield close()

    return materialize(with_first(pages, smallest).mapInArrow(save, INDEX), "warc-index")


_INDEX_SCHEMA = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
    ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
])


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (file, offset, length) rows as (file, start, end, members) of joined ranges."""
    held: list[tuple[int, int]] = []
    name, start, end = "", 0, 0
    for file, offset, length in rows:
        if held and (file != name or offset > end + GAP_BYTES or offset + length - start > FETCH_BYTES):
            yield name, start, end, held
            held = []
        if not held:
            name, start, end = file, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield name, start, end, held


def read(index: DataFrame) -> DataFrame:
    """The records that the index rows name: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    n = parts(index.sparkSession)
    sorted_rows = (
        index.select("file", "offset", "length")
        .repartition(n, "file", F.floor(F.col("offset") / STRETCH_BYTES))
        .sortWithinPartitions("file", "offset")
    )
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, stream = "", None
            for file, start, end, members in ranges(list(zip(*(c.to_pylist() for c in batch.columns)))):
                if file != name:
                    if stream is not None:
                        stream.close()
                    name, stream = file, files.open_old(file)
                content = memoryview(stream.read_at(end - start, start))
                found, held = [], 0
                for offset, length in members:
                    found.append(parse(gzip.decompress(content[offset - start:offset - start + length])))
                    held += len(found[-1]["payload"] or b"")
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(found, schema=schema)
                        found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)
            if stream is not None:
                stream.close()

    return sorted_rows.mapInArrow(
        fetch, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary",
    )


def round_trip(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Write all pages, then read every record by the index."""
    index = write(pages, new_path(pages.sparkSession, "warc"), smallest)
    return read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
