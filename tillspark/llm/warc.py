"""WARC archives: written with one gzip member per record, read back in sequence.

An archive is a binary value, a whole `.warc.gz` file of a few MB, in a column
`content`: what `write_archives` stages and what Spark's `binaryFile` source
gives for files on disk. The reader inflates a member piece by piece, frames the
block by Content-Length, and checks block and payload digests; a record that is
cut short or does not match its digest raises.

Payloads of at least `REVISIT_BYTES` that are equal are stored once: the page
with the smallest page_id holds the response, the others are revisit records
that name it and keep only the HTTP header. A null html is an empty payload. A
null url is an empty target; a null page_id counts as larger than any other and
comes back null. Rows that share the smallest page_id and the payload are each
a response. Other columns are ignored; an empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.text import byte_column
from tillspark.operators.lookup import lookup
from tillspark.sources.staging import stage

REVISIT_BYTES = 100
ARCHIVE_BYTES = 4 << 20
PIECE = 64 << 10
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = re.compile(r"<urn:page:(-?\d*)>")


def write_archives(
    pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Archives of all pages, as staged rows of one column `content`."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", "html", F.unhex(F.sha2(payload, 256)).alias("digest"))
    ids = stage(
        hashed.where(F.length(payload) >= revisit_bytes).select("page_id", "digest"), "warc-ids"
    )
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    # A page copied through a third of the crawl is one digest: its rows are dealt out.
    several = lookup(ids, first.where("n > 1").withColumn("held", F.lit(True)), "digest", ["page_id"])
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))
    revisits = several.where(F.col("held") & later).select("page_id", "digest", "refers_to").distinct()
    chosen = [revisits[c].alias(f"r_{c}") for c in ("page_id", "digest", "refers_to")]
    revisits = revisits.select(*chosen)
    same = hashed["page_id"].eqNullSafe(revisits["r_page_id"])
    records = hashed.join(revisits, same & (hashed["digest"] == revisits["r_digest"]), "left")
    records = records.select("page_id", "url", "html", F.col("r_refers_to").alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[bytes] = []
        size = 0
        for batch in batches:
            ids, urls, _, refers = (column.to_pylist() for column in batch.columns)
            rows = zip(ids, urls, byte_column(batch, "html"), refers, strict=True)
            for page_id, url, html, refers_to in rows:
                members.append(_member(page_id, url or "", html, refers_to))
                size += len(members[-1])
                if size >= archive_bytes:
                    yield _archive(members)
                    members, size = [], 0
        if members:
            yield _archive(members)

    return stage(records.mapInArrow(write, "content binary"), "warc-archives")


def _archive(members: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"content": [b"".join(members)]})


def _member(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%~"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    record = [f"WARC/1.1\r\n{lines}\r\n".encode(), block, b"\r\n\r\n"]
    return b"".join([*(packer.compress(part) for part in record), packer.flush()])


def _inflated(content: bytes) -> Iterator[bytes]:
    """The members of a file in turn, each inflated piece by piece."""
    view, at = memoryview(content), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            piece = view[at : at + PIECE]
            if not len(piece):
                raise ValueError("archive ends inside a record")
            parts.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        yield b"".join(parts)


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an archive, framed and checked."""
    for member in _inflated(content):
        head, found, rest = member.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = {n.lower(): v for n, _, v in (line.partition(": ") for line in lines)}
        size = int(fields.get("content-length", -1))
        if not found or not version.startswith("WARC/") or size < 0:
            raise ValueError("not a WARC record")
        block, end = rest[:size], rest[size:]
        if len(block) != size or end != b"\r\n\r\n":
            raise ValueError(f"{fields.get('warc-record-id')}: block is not Content-Length long")
        _check(fields, "warc-block-digest", block)
        yield fields, block


def _check(fields: dict[str, str], name: str, data: bytes) -> None:
    kind, _, expected = fields.get(name, "").partition(":")
    if kind == "sha256" and hashlib.sha256(data).hexdigest() != expected:
        raise ValueError(f"{fields.get('warc-record-id')}: {name} does not match")


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload of every
    record; the payload of a revisit is null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in records_of(content.as_py()):
                    rows.append(_row(fields, block))
                    size += len(block)
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, _READ)

    return archives.select("content").mapInArrow(
        read,
        "page_id long, url string, record_type string, refers_to long, "
        "payload_bytes long, payload_digest string, payload binary",
    )


_READ = pa.schema(
    {
        "page_id": pa.int64(),
        "url": pa.string(),
        "record_type": pa.string(),
        "refers_to": pa.int64(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "payload": pa.binary(),
    }
)


def _row(fields: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    kept = fields["warc-type"] == "response"
    if kept:
        if len(payload) != size:
            raise ValueError(f"{fields.get('warc-record-id')}: payload is not {size} bytes long")
        _check(fields, "warc-payload-digest", payload)
    return {
        "page_id": _page(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": fields["warc-payload-digest"].partition(":")[2],
        "payload": payload if kept else None,
    }


def _page(uri: str | None) -> int | None:
    found = ID.fullmatch(uri or "")
    return int(found[1]) if found and found[1] else None
