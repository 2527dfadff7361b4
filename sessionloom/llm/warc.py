"""WARC records in seekable Zstandard bundles.

A bundle is a sequence of independent Zstandard frames, each with some whole
records, followed by a seek table in a skippable frame.  An index maps record
identifiers to a frame and an offset within it, so that one record can be read
by decompressing one frame.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from .arrow import schema_of

# Fixed values of the seekable format: skippable frame and footer.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 24
LEVEL = 3

BUNDLES = (
    "bundle string, data binary, index array<struct<record_id:string,page_id:long,frame:int,offset:long,length:long>>"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, record_id: str) -> bytes:
    """One WARC/1.1 record; a revisit carries headers only."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{identifier(refers_to)}>")
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def identifier(page_id) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def parse(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


class Bundle:
    """Gathers records into frames and closes with the seek table."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.frame: list[bytes] = []
        self.size = self.total = 0
        self.out: list[bytes] = []
        self.table: list[tuple[int, int]] = []
        self.index: list[dict] = []

    def add(self, record_id: str, page_id, block: bytes) -> None:
        entry = {"record_id": record_id, "page_id": page_id, "frame": len(self.table), "offset": self.size}
        self.index.append(entry | {"length": len(block)})
        self.frame.append(block)
        self.size += len(block)
        self.total += len(block)
        if self.size >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.frame:
            packed = self.packer.compress(b"".join(self.frame))
            self.out.append(packed)
            self.table.append((len(packed), self.size))
            self.frame, self.size = [], 0

    def close(self) -> bytes:
        self.end_frame()
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        head = struct.pack("<II", SKIPPABLE, len(entries) + len(footer))
        return b"".join(self.out) + head + entries + footer


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, packed size, unpacked size) of every frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    at, out = 0, []
    for packed, size in struct.iter_unpack("<II", data[len(data) - 9 - 8 * n : len(data) - 9]):
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(data: bytes, frame: tuple[int, int, int]) -> bytes:
    at, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=size) if size else b""


def write_bundles(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 0
) -> DataFrame:
    """Bundles of all pages, one row each: bundle, data (the file), index.

    Of pages with equal payloads of at least ``least`` bytes the one with the
    smallest id is a response, the others are revisits that refer to it.  A
    null body is empty; a page without id is a revisit if a page with an id
    has its payload, else a response.  Repeated rows with the smallest id are
    all responses.  The bundle name is made from its content, so a task that
    runs again gives the same bundle.
    """
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    url = F.col(url_col).cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), body.alias("body"))

    rows = rows.withColumn("digest", F.sha1("body"))
    digests = cut(rows.select("page_id", "digest"))
    first = (
        digests.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "refers_to")
    )
    again = digests.join(first, "digest").where("NOT page_id <=> refers_to").distinct()
    keyed = (
        rows.alias("p")
        .join(again.alias("a"), F.expr("p.page_id <=> a.page_id AND p.digest = a.digest"), "left")
        .select("p.page_id", "url", "body", "refers_to")
    )
    arrow = to_arrow_schema(schema_of(BUNDLES))

    def write(batches):
        bundle = Bundle()

        def done(bundle):
            data = bundle.close()
            name = hashlib.sha256(data).hexdigest()[:32]
            return pa.RecordBatch.from_pylist([{"bundle": name, "data": data, "index": bundle.index}], schema=arrow)

        for batch in batches:
            for page_id, url, body, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                payload = body.encode("utf-8", "surrogatepass")
                own = payload_digest(payload)
                if len(payload) < least:
                    refers_to = None
                name = identifier(page_id)
                bundle.add(name, page_id, record(page_id, url, payload, own, refers_to, name))
                if bundle.total >= BUNDLE_BYTES:
                    yield done(bundle)
                    bundle = Bundle()
        if bundle.index:
            yield done(bundle)

    return cut(keyed.mapInArrow(write, schema_of(BUNDLES)))


def read_records(bundles: DataFrame) -> DataFrame:
    """All records of the bundles, read frame by frame through seek table and index.

    page_id, url, record_type, refers_to, payload_digest, payload_bytes (of the
    full payload), payload (empty for revisits).  A response whose bytes do not
    have the digest of its header fails.
    """
    ddl = (
        "page_id long, url string, record_type string, refers_to long, payload_digest string,"
        " payload_bytes long, payload binary"
    )
    arrow = to_arrow_schema(schema_of(ddl))

    def read(batches):
        for batch in batches:
            for data, index in zip(batch.column("data"), batch.column("index"), strict=True):
                data, index = data.as_py(), index.as_py()
                frames = seek_table(data)
                by_frame: dict[int, list[dict]] = {}
                for e in index:
                    by_frame.setdefault(e["frame"], []).append(e)
                for k, entries in by_frame.items():
                    block = read_frame(data, frames[k])
                    out = []
                    for e in entries:
                        fields, payload = parse(block[e["offset"] : e["offset"] + e["length"]])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        refers = fields.get("WARC-Refers-To")
                        if refers is None and payload_digest(payload) != digest:
                            raise ValueError(f"damaged record {e['record_id']}")
                        out.append(
                            {
                                "page_id": e["page_id"],
                                "url": fields["WARC-Target-URI"],
                                "record_type": fields["WARC-Type"],
                                "refers_to": None if refers is None else int(refers.rpartition(":")[2].rstrip(">")),
                                "payload_digest": digest,
                                "payload_bytes": int(fields["X-Payload-Length"]),
                                "payload": payload,
                            }
                        )
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return bundles.select("data", "index").mapInArrow(read, schema_of(ddl))


def export_bundles(bundles: DataFrame, folder: str) -> None:
    """Write every bundle as a .warc.zst file into a folder that all executors mount."""

    def write(batches):
        for batch in batches:
            for name, data in zip(batch.column("bundle").to_pylist(), batch.column("data").to_pylist(), strict=True):
                part = os.path.join(folder, f".{name}.{os.getpid()}")
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, os.path.join(folder, f"{name}.warc.zst"))
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    bundles.select("bundle", "data").mapInArrow(write, "n long").agg(F.sum("n")).collect()
