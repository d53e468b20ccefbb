"""WARC archives with an index first: written by tasks, read back by coalesced byte ranges.

Each task writes one archive of gzip members (a member per record) and returns
an index row per record: file, offset, length, URL, digest.  Reading sorts the
selected index rows by place, joins neighbouring ranges into single reads, and
parses the records inside.

File names are drawn per attempt and the index lists only the attempts that
succeeded, so a lost executor's half-written archive is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import checkpoint, filesystem, map_arrow, new_folder, per_key

INDEX = "file string, offset long, length long, url string, digest string, page_id long"
#: Ranges with at most this much between them are read at once, up to READ bytes.
GAP, READ = 64 << 10, 8 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """A gzip member with one record, and its payload digest.  A null url is left out; control characters are escaped."""
    digest = payload_digest(payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is None:
        block = HTTP % len(payload) + payload
        head.append("Content-Type: application/http; msgtype=response")
    else:
        block = b""
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    gz = zlib.compressobj(4, zlib.DEFLATED, 31)
    return gz.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + gz.flush(), digest


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2] if headers["WARC-Type"] == "response" else b""


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: the page whose response a revisit names.

    Of equal payloads of at least ``least`` bytes the largest page_id is the
    response.  Pages without an identifier can only revisit; rows that repeat
    the largest identifier with the same payload are all responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    best = per_key(rows.where(F.octet_length("payload") >= least).select("key", "page_id"), ["key"], F.max("page_id").alias("best"))
    revisit = F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    return rows.join(best, "key", "left").select("page_id", "url", "payload", F.when(revisit, F.col("best")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the index, which is checkpointed.

    ``folder`` must be one that all executors share; by default a new one
    beside the checkpoints.  Null html is an empty payload; an empty table
    writes nothing; extra columns are ignored.
    """
    where = folder or new_folder(pages.sparkSession, "warc")
    fs, path = filesystem(where)
    fs.create_dir(path, recursive=True)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(where)
        name, out, at = f"{base}/{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                rows: list[list] = [[] for _ in range(6)]
                for page_id, url, payload, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if out is None:
                        out = store.open_output_stream(name, compression=None)
                    member, digest = record(page_id, url, payload, refers_to)
                    out.write(member)
                    for c, v in zip(rows, (name, at, len(member), url, digest, page_id), strict=True):
                        c.append(v)
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                    ["file", "offset", "length", "url", "digest", "page_id"],
                )
        finally:
            if out is not None:
                out.close()

    return checkpoint(map_arrow(with_revisits(pages, least), write, INDEX))


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name: page_id, url, record_type, refers_to, digest, bytes and (if asked for) payload.

    A payload that doesn't have the digest in its header is an error.
    """
    chunk = F.floor(F.col("offset") / READ)
    placed = index.select("file", "offset", "length", "url").repartition("file", chunk).sortWithinPartitions("file", "offset")
    schema = "page_id long, url string, record_type string, refers_to long, digest string, bytes long" + (", payload binary" if with_payload else "")
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns], strict=True))
            at = 0
            while at < len(rows):
                end = at + 1
                while end < len(rows) and rows[end][0] == rows[at][0] and rows[end][1] - sum(rows[end - 1][1:3]) <= GAP and sum(rows[end][1:3]) - rows[at][1] <= READ:
                    end += 1
                first, out = rows[at][1], [[] for _ in names]
                with store.open_input_file(rows[at][0]) as f:
                    held = f.read_at(sum(rows[end - 1][1:3]) - first, first)
                for _, offset, length, url in rows[at:end]:
                    headers, payload = parse(held[offset - first : offset - first + length])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = headers["WARC-Type"] == "response"
                    if response and payload_digest(payload) != digest:
                        raise ValueError(f"record at {offset} of {rows[at][0]}: payload and digest differ")
                    page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id")
                    row = [page and int(page), url, headers["WARC-Type"], refers and int(refers), digest, len(payload) if response else None]
                    for c, v in zip(out, row + [payload] * with_payload, strict=True):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                at = end

    return map_arrow(placed, read, schema)


def page_records(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write ``pages`` and read every record back: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    A revisit holds no payload; its size is that of the response it refers to.
    """
    where = folder or new_folder(pages.sparkSession, "warc")
    found = checkpoint(read_records(write_archives(pages, where, least), where, with_payload=False))
    sizes = found.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "digest", "bytes")
    sizes = per_key(sizes, ["refers_to", "digest"], F.max("bytes").alias("full"))
    return found.join(sizes, ["refers_to", "digest"], "left").select(
        "page_id", "url", F.coalesce("bytes", "full").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
