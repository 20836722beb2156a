"""WARC archives with an index, and indexed reads.

Every record is a gzip member of its own. Of records with equal payloads of at least
``REVISIT_BYTES``, the one with the smallest id is a response and the others are revisits of it.
The tasks that write return the index: file, offset, length, URL and digest of each record. Reads
begin with the index: its selected rows are sorted by place, neighbours closer than ``GAP`` become
one byte range of up to ``RANGE`` bytes, and the records are cut out of the ranges.

Defined cases: null html is empty; a null URL has no target field; a row without an id is always a
response; rows that share id and payload have the same type; an empty table has no archive."""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfstream.llm import files
from shelfstream.session import fresh_path, materialise

REVISIT_BYTES = 100
FILE_BYTES = 32 << 20
GAP, RANGE = 64 << 10, 4 << 20
DATE = "1970-01-01T00:00:00Z"  # the table has no time of capture
ID = "urn:shelfstream:page:"

INDEX = "page_id long, url string, digest string, payload_bytes long, record_type string, file string, offset long, length long"
_INDEX = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()),
    ("record_type", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
])


def record(page_id, url, digest: str, payload: bytes, refers_to) -> bytes:
    """One compressed record; a revisit if it refers to a page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{'none' if page_id is None else page_id}>"), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [
            ("WARC-Refers-To", f"<{ID}{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(3, wbits=31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of a compressed record."""
    raw = zlib.decompress(data, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _page(uri: str | None) -> int | None:
    number = uri.strip("<>").removeprefix(ID) if uri else "none"
    return None if number == "none" else int(number)


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Write all pages; returns the index, one row per record."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    keyed = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("payload") >= REVISIT_BYTES)).select(
        "page_id", "digest"
    )
    firsts = keyed.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    revisits = (
        keyed.join(firsts.filter("n > 1"), "digest").filter("page_id != refers_to")
        .groupBy("page_id", "digest").agg(F.min("refers_to").alias("refers_to"))
    )
    typed = rows.join(revisits, ["page_id", "digest"], "left").select(
        "page_id", "url", "payload", "digest", "refers_to"
    )

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        held, index, size = [], [], 0

        def close():
            name = f"{folder}/part-{task:06d}-{number:06d}.warc.gz"
            files.write_bytes(name, b"".join(held))
            return pa.RecordBatch.from_pylist([{**x, "file": name} for x in index], schema=_INDEX)

        for batch in batches:
            for page, link, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                data = record(page, link, digest, payload, first)
                index.append({
                    "page_id": page, "url": link, "digest": digest, "payload_bytes": len(payload),
                    "record_type": "response" if first is None else "revisit", "offset": size, "length": len(data),
                })
                held.append(data)
                size += len(data)
                if size >= FILE_BYTES:
                    yield close()
                    held, index, size, number = [], [], 0, number + 1
        if held:
            yield close()

    return materialise(typed.mapInArrow(run, INDEX), "warc-index")


def coalesce(places: list[tuple[int, int]], gap: int = GAP, most: int = RANGE) -> list[tuple[int, int, int]]:
    """Byte ranges (offset, length, number of records) over sorted places (offset, length)."""
    ranges: list[list[int]] = []
    for offset, length in places:
        if ranges and 0 <= offset - sum(ranges[-1][:2]) <= gap and offset + length - ranges[-1][0] <= most:
            ranges[-1][1:] = [offset + length - ranges[-1][0], ranges[-1][2] + 1]
        else:
            ranges.append([offset, length, 1])
    return [tuple(r) for r in ranges]


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(selected: DataFrame) -> DataFrame:
    """The records of index rows, by coalesced byte ranges. A revisit has no payload of its own:
    its digest and number of bytes are those its record states."""
    order = [F.col("file"), F.col("offset")]
    placed = selected.select("file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        names = [x.split()[0] for x in READ.split(", ")]
        for batch in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                by_file.setdefault(name, []).append((offset, length))
            for name, places in by_file.items():
                ranges, at = coalesce(places), 0
                for (start, _, n), data in zip(ranges, files.read_ranges(name, [r[:2] for r in ranges])):
                    out = []
                    for offset, length in places[at : at + n]:
                        fields, http, payload = parse(data[offset - start : offset - start + length])
                        stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        first = _page(fields.get("WARC-Refers-To"))
                        if first is None and hashlib.sha256(payload).hexdigest() != stated:
                            raise ValueError(f"damaged record at {name}:{offset}")
                        out.append((
                            _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"),
                            int(http["Content-Length"]) if first is not None else len(payload), stated,
                            fields["WARC-Type"], first, None if first is not None else payload,
                        ))
                    at += n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), _READ_TYPES)], names
                    )

    return placed.mapInArrow(run, READ)


_READ_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages to archives in the shared folder and read all records back."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, page_id, url, html))
