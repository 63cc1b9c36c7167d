"""WARC archives: writing, normalising to one gzip member per record with an offset index, and reading back.

`write_archives` gives each task's records one gzip stream per file, as many crawlers do. `normalise` inflates such a
file once, from front to back, and writes every record as a member of its own together with a sidecar index of
(offset, length), so that any record can be read alone. `read_archives` reads by that index. Files are written under
names of their own and reported only by the attempt that ends well, so a task that runs twice leaves a spare file and
never a broken one. Records are copied in blocks; only the parser of a read holds one record at a time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.skew import lookup
from tidemark.session import scratch_path, stored

LEVEL = 3
BLOCK = 1 << 20
FILE_BYTES = 1 << 30  # of payload in one archive
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """Name-based id: a record that is written again keeps it, and a revisit can name that of its response. Repeated rows
    share one; pages without an id go by their address."""
    name = f"page:{page_id}" if page_id is not None else f"url:{url}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}:{digest}')}>"


def record(page: dict) -> bytes:
    """One WARC record. A revisit has headers only; its payload is that of the page it refers to."""
    payload = (page["html"] or "").encode()
    revisit = page["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    known = page["page_id"] is not None
    digest = payload_digest(payload)
    head = {
        "WARC-Type": page["record_type"],
        "WARC-Record-ID": record_id(page["page_id"], page["url"], digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if page["url"] is None else quote(page["url"], safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": REVISIT if revisit else None,
        "WARC-Refers-To": record_id(page["refers_to"], None, digest) if revisit else None,
        "WARC-Refers-To-Page": str(page["refers_to"]) if revisit else None,
        "WARC-Page": str(page["page_id"]) if known else None,
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write `pages` (page_id, url, html, record_type, refers_to) as monolithic archives; rows (file, records)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = out = packer = None
        name, count, size = "", 0, 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"file": [name], "records": [count]})

        for batch in batches:
            for page in (p for k in range(0, batch.num_rows, 64) for p in batch.slice(k, 64).to_pylist()):
                if out is not None and size >= FILE_BYTES:
                    yield close()
                    out = None
                if out is None:
                    system, root = _open(folder)
                    system.create_dir(root, recursive=True)
                    name, count, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(_open(name)[1], compression=None)
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = record(page)
                out.write(packer.compress(raw))
                count, size = count + 1, size + len(raw)
        if out is not None:
            yield close()

    return stored(pages.select("page_id", "url", "html", "record_type", "refers_to").mapInArrow(work, "file string, records long"), "archives")


def _head(reader: BinaryIO) -> tuple[bytes, dict[str, str]] | None:
    """Raw head of the next record and its fields, or None at the end."""
    line = reader.readline()
    while line in (b"\r\n", b"\n"):
        line = reader.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {line[:40]!r}")
    raw, fields = [line], {}
    while (line := reader.readline()) not in (b"\r\n", b"\n", b""):
        raw.append(line)
        name, _, value = line.decode("utf-8").partition(":")
        fields[name.strip().lower()] = value.strip()
    return b"".join([*raw, b"\r\n"]), fields


def normalise_file(source: BinaryIO, target: BinaryIO) -> Iterator[dict]:
    """Copy the records of a gzip stream (of one or more members) as members of their own; yields index entries."""
    reader = io.BufferedReader(gzip.GzipFile(fileobj=source), BLOCK)
    offset = 0
    while (head := _head(reader)) is not None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        length = 0

        def put(data: bytes) -> None:
            nonlocal length
            target.write(data)
            length += len(data)

        put(packer.compress(head[0]))
        left = int(head[1]["content-length"])
        while left:
            block = reader.read(min(left, BLOCK))
            if not block:
                raise ValueError("the archive ends inside a record")
            left -= len(block)
            put(packer.compress(block))
        put(packer.compress(b"\r\n\r\n") + packer.flush())
        yield {"offset": offset, "length": length, "id": head[1].get("warc-record-id"), "type": head[1].get("warc-type")}
        offset += length


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrite each file of `archives` beside it: rows (file, index, records); the index has one JSON line a record."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                stem = f"{name.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}"
                system, path = _open(name)
                target, index = f"{stem}.members.warc.gz", f"{stem}.index.jsonl"
                count = 0
                with (
                    system.open_input_stream(path, compression=None) as source,
                    system.open_output_stream(_open(target)[1], compression=None) as out,
                    system.open_output_stream(_open(index)[1], compression=None) as side,
                ):
                    for entry in normalise_file(source, out):
                        side.write(json.dumps(entry).encode() + b"\n")
                        count += 1
                yield pa.RecordBatch.from_pydict({"file": [target], "index": [index], "records": [count]})

    spread = archives.repartition(max(1, archives.count()), "file")
    return stored(spread.mapInArrow(work, "file string, index string, records long"), "members")


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _parsed(member: bytes) -> dict | None:
    """A response or revisit as a row; None for records of other types (warcinfo, request, metadata, ...).

    Fields that a foreign record lacks are null. Its digest is checked where it is a SHA-1 and else made from the payload.
    """
    reader = io.BytesIO(member)
    fields = _head(reader)[1]
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = reader.read(int(fields["content-length"]))
    http = "http" in fields.get("content-type", "application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    number = lambda key: int(fields[key]) if fields.get(key, "").isdigit() else None
    revisit = kind == "revisit"
    given = fields.get("warc-payload-digest", "")
    digest = given.removeprefix("sha1:").upper() if given.startswith("sha1:") else None
    if not revisit:
        own = payload_digest(payload)
        if digest not in (None, own):
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not have its digest")
        digest = own
    return {
        "page_id": number("warc-page"),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": number("warc-payload-length") if revisit else len(payload),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("warc-refers-to-page"),
        "payload": None if revisit else payload,
    }


def read_archives(members: DataFrame, payloads: bool = True) -> DataFrame:
    """Responses and revisits of normalised archives (file, index), each read by its offset.

    `payloads=False` leaves payload null. Records of other types are passed over. One record at a time is held, so the
    largest payload, not the archive, bounds the memory.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, index in zip(batch.column("file").to_pylist(), batch.column("index").to_pylist(), strict=True):
                system, path = _open(name)
                with system.open_input_file(path) as source, system.open_input_stream(_open(index)[1], compression=None) as side:
                    rows, held = [], 0
                    for line in io.BufferedReader(side, BLOCK):
                        entry = json.loads(line)
                        row = _parsed(gzip.decompress(source.read_at(entry["length"], entry["offset"])))
                        if row is None:
                            continue
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 4 * BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    spread = members.repartition(max(1, members.count()), "file")
    return spread.mapInArrow(work, RECORDS)


SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add record_type and refers_to to `pages` (page_id, url, html).

    Of pages with equal payloads of `least_bytes` or more the one with the smallest page_id is the response and the
    others revisit it; rows that repeat that page_id are responses too. Smaller payloads are all responses. A null html
    is an empty payload. A null page_id comes last; if no page of a group has an id, all are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("_digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    large = rows.where(F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes)
    groups = large.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    marked = lookup(rows, stored(groups, "payload-groups"), "_digest", spread_by=("page_id",))
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return marked.select(
        "page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("_first")).alias("refers_to")
    )


def round_trip(pages: DataFrame, least_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Write `pages` as archives in the shared folder, normalise them and read every record back.

    One row per row of `pages`, repeated rows and null ids too; an empty table gives none, null html an empty payload and a
    null url none. Other columns are not looked at.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    archives = write_archives(with_record_types(pages, least_bytes), folder)
    return read_archives(normalise(archives), payloads)
