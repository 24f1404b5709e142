"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding a group of whole WARC/1.1 records,
and a last skippable frame with the seek table of the public seekable format: compressed and
decompressed size per frame, then frame count, descriptor and magic number. The record index maps
a record id to (bundle, frame, offset inside the frame, length), so one record is read by
decompressing one frame.

Among records with equal payloads (SHA-1 and length) of at least `least` bytes the one with the
smallest page_id is the response, all others are revisits that refer to it and carry no payload.
Rows that share the smallest page_id are all responses. Null html is an empty payload, a null url an
empty target, a null page_id is written as an empty id and is never referred to. Very long payloads make
a frame of their own. Other columns are ignored. An empty table writes no bundle.

Tasks write their own bundles and return the index rows; only rows of successful attempts reach
the index, so a repeated attempt leaves an unreferenced file and no wrong record. Paths may be any
that pyarrow's file systems open (file, hdfs, s3).
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir, stage
from .common import batch_of, rows, slices, utf8

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 20, 64 << 20, 3
INDEX = "page_id long, record_id string, bundle string, frame int, start long, length long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def payload_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[str, bytes]:
    """Record id and bytes of one WARC record."""
    name = "" if page_id is None else str(page_id)
    record_id = f"<urn:page:{name}>"
    target = "".join(c for c in url or "" if c not in "\r\n")
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{payload_sha1(payload)}", f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append(f"Content-Length: {len(body)}")
    return record_id, "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at `start`, and where the next one begins."""
    end = data.index(b"\r\n\r\n", start)
    first, *lines = data[start:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no WARC record at {start}")
    headers = dict(line.split(": ", 1) for line in lines)
    body = end + 4
    stop = body + int(headers["Content-Length"])
    return headers, data[body:stop], stop + 4


class BundleWriter:
    """Writes records to one bundle; `add` gives (frame, start, length)."""

    def __init__(self, path: str, frame_bytes: int = FRAME_BYTES) -> None:
        files, at = _open(path)
        self.out, self.frame_bytes = files.open_output_stream(at, compression=None), frame_bytes
        self.buffer, self.frames, self.size = bytearray(), [], 0
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, data: bytes) -> tuple[int, int, int]:
        if self.buffer and len(self.buffer) + len(data) > self.frame_bytes:
            self._cut()
        place = len(self.frames), len(self.buffer), len(data)
        self.buffer += data
        return place

    def _cut(self) -> None:
        packed = self.zstd.compress(bytes(self.buffer))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.buffer)))
        self.size += len(packed)
        self.buffer = bytearray()

    def close(self) -> None:
        if self.buffer:
            self._cut()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        table = entries + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class Bundle:
    """Random access to one bundle through its seek table."""

    def __init__(self, path: str) -> None:
        files, at = _open(path)
        self.file = files.open_input_file(at)
        size = self.file.size()
        self.file.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        width = 12 if descriptor & 0x80 else 8
        self.file.seek(size - 9 - n * width)
        table = self.file.read(n * width)
        self.frames, start = [], 0
        for i in range(n):
            packed, plain = struct.unpack_from("<II", table, i * width)
            self.frames.append((start, packed, plain))
            start += packed

    def frame(self, i: int) -> bytes:
        start, packed, plain = self.frames[i]
        self.file.seek(start)
        return zstandard.decompress(self.file.read(packed), max_output_size=plain)


def _write(folder: str, frame_bytes: int, bundle_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path = None, ""
        for batch in slices(batches):
            out: list[tuple] = []
            for page_id, url, payload, first in zip(
                batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), utf8(batch, "html"),
                batch.column("first_id").to_pylist(), strict=True,
            ):
                if writer is None:
                    path = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(path, frame_bytes)
                refers_to = None if first is None or first == page_id else first
                record_id, data = record(page_id, url, payload or b"", refers_to)
                out.append((page_id, record_id, path, *writer.add(data)))
                if writer.size >= bundle_bytes:
                    writer.close()
                    writer = None
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            names = [c.split()[0] for c in INDEX.split(", ")]
            yield batch_of({n: (k, [o[i] for o in out]) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})
        if writer is not None:
            writer.close()

    return run


def write_archive(
    pages: DataFrame, folder: str, least: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write all pages under `folder` and return the record index, itself written to the shared folder."""
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    page = page.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html")})
    first = page.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.min("page_id").alias("first_id"))
    # both sides are shuffled by payload; a payload that many pages share is split by the adaptive skew join
    ready = page.join(first, ["digest", "bytes"], "left").select("page_id", "url", "html", "first_id")
    fs_, at = _open(folder)
    fs_.create_dir(at, recursive=True)
    return stage(ready.mapInArrow(_write(folder, frame_bytes, bundle_bytes), INDEX), "warc-index")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records at the index's places; rows come sorted by (bundle, frame), so each frame is opened once."""
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    bundle, opened = "", None
    for (path, number), places in groupby(rows(batches, "bundle", "frame", "start", "length"), lambda r: r[:2]):
        if path != bundle:
            bundle, opened = path, Bundle(path)
        data, out = opened.frame(number), []
        for _, _, start, length in places:
            headers, block, _ = parse(data[start:start + length])
            revisit = headers["WARC-Type"] == "revisit"
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if not revisit and payload_sha1(block) != digest:
                raise ValueError(f"{headers['WARC-Record-ID']} does not match its digest")
            page, other = (headers.get(h, "<urn:page:>")[10:-1] for h in ("WARC-Record-ID", "WARC-Refers-To"))
            out.append((
                int(page) if page else None, int(headers["X-Payload-Length"]), digest, headers["WARC-Type"],
                int(other) if other else None, headers["WARC-Target-URI"], None if revisit else block,
            ))
        yield batch_of({n: (k, [o[i] for o in out]) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def read_archive(index: DataFrame) -> DataFrame:
    """The records an index names (all of them, or those a filter on it leaves)."""
    return index.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "start").mapInArrow(_read, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write the pages, read the archives back; the folder is a new one in the shared folder unless given."""
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_archive(write_archive(pages, folder, least))
