"""WARC archives with an index first: write, index, then read selected records by byte range.

Every record is a gzip member of its own, so a byte range decodes alone. A task writes archive
files under names no other attempt uses, and returns the index rows of what it wrote; the index
therefore names exactly the files of the attempts that counted, and others are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselog.llm.common import written

#: Payloads of at least so many bytes may be replaced by a reference to an equal one.
REVISIT_BYTES = 1000
#: An archive file is closed beyond this size.
FILE_BYTES = 64 << 20
#: Byte ranges with a gap up to GAP are read at once, up to READ bytes.
GAP = 64 << 10
READ = 4 << 20
# Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

INDEX = (
    "page_id bigint, record_type string, url string, digest string, "
    "file string, offset bigint, length bigint"
)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    revisit = refers_to is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {EPOCH}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[5:5] = [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; raises where lengths or digests disagree."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line[:-1], "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (
        len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError(f"payload differs from its digest: {fields['WARC-Record-ID']}")
    number = lambda name: int(n) if (n := fields.get(name, "")[10:-1]) else None
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def typed(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): of equal long payloads the largest id is kept.

    Only ids, lengths and digests are grouped, counts before shuffling; a very common payload
    is one row for each task there. ``refers_to`` is null where the record is a response.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html).alias("digest")
    )
    narrow = pages.where(F.length("html") >= REVISIT_BYTES)
    groups = narrow.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
    again = narrow.select("page_id", "digest").join(groups.where("n > 1"), "digest")
    again = again.where("page_id < kept").select("page_id", "digest", "kept").distinct()
    return pages.join(again, ["page_id", "digest"], "left").select(
        "page_id", "url", "html", "digest", F.col("kept").alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each page (page_id, url, html) below ``folder``; returns the index.

    ``folder`` must be one that pyarrow's file systems reach from every executor. Null html is an
    empty payload, null url an empty one; a null page_id is kept and never refers to a record.
    Pages that repeat a page_id get a record each; equal ones are not revisits of themselves.
    """

    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for row in part.to_pylist():
                    if out is None:
                        name, out, size = f"{uuid.uuid4().hex}.warc.gz", None, 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = record(
                        row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"]
                    )
                    data = gzip.compress(data, 6, mtime=0)
                    out.write(data)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    rows.append(
                        (row["page_id"], kind, row["url"], row["digest"], name, size, len(data))
                    )
                    size += len(data)
                    if size >= FILE_BYTES:
                        out.close()
                        out = None
                names = [x.split()[0] for x in INDEX.split(", ")]
                types = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, names)
        if out is not None:
            out.close()

    return written(typed(pages).mapInArrow(write, INDEX), "warc-index")


def ranges(spans: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Sorted (offset, length) spans, those that one read fetches together."""
    groups: list[list[tuple[int, int]]] = []
    for offset, length in spans:
        if groups:
            first, last = groups[-1][0][0], sum(groups[-1][-1])
            if offset - last <= GAP and offset + length - first <= READ:
                groups[-1].append((offset, length))
                continue
        groups.append([(offset, length)])
    return groups


RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, payload binary"
)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the selected index rows, read in sorted, coalesced byte ranges."""
    zone = F.floor(F.col("offset") / READ)
    index = index.select("file", "offset", "length", zone.alias("zone"))
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = index.repartition(parts, "file", "zone").sortWithinPartitions("file", "offset")

    def read(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows, spans = batch.to_pylist(), {}
            for row in rows:
                spans.setdefault(row["file"], []).append((row["offset"], row["length"]))
            for name, own in spans.items():
                with store.open_input_file(f"{root}/{name}") as source:
                    for group in ranges(own):
                        first = group[0][0]
                        source.seek(first)
                        data = memoryview(source.read(sum(group[-1]) - first))
                        out = [
                            parse(zlib.decompress(data[o - first : o - first + n], 31))
                            for o, n in group
                        ]
                        yield pa.RecordBatch.from_pylist(out, schema=_record_schema())

    return index.mapInArrow(read, RECORD)


def _record_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in RECORD.split(", "))])
