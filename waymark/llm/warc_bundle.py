"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with whole WARC/1.1 records, then two skippable
frames: the record map (page id, frame, offset in the frame's plain bytes) and the seek table of the
Zstandard seekable format. A reader takes the seek table from the file's end, and any record from one frame.

Pages with equal payloads of at least MIN_REVISIT bytes are stored once: the smallest page_id is the response,
the rest are revisits that refer to it. The payloads' SHA-1 are grouped with partial aggregation, and only
digests with several pages are joined back, so one payload that a third of all pages share is one row of that
join; its page side is split by adaptive execution. Files are written under temporary names and renamed.

A null html is an empty payload. Rows with the same page_id and payload are all responses where that id is the
smallest; a null page_id refers to the smallest id, or is a response if its payload has none. A payload of any length
is one record in one frame. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.common import SharedFiles, shared_folder, small_batches

MIN_REVISIT = 0
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
SKIPPABLE_MAP, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
MAP_ROW = np.dtype([("page", "<i8"), ("null", "u1"), ("frame", "<u4"), ("offset", "<u4")])
CAPTURED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

BUNDLES = T.StructType([T.StructField("bundle", T.StringType()), T.StructField("records", T.LongType())])
ROWS = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("url", T.StringType())])
ROWS_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def record_id(page_id: int | None) -> str:
    return f"<urn:waymark:page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.rpartition(":")[2].rstrip(">")
    return int(number) if number else None


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with headers alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {CAPTURED}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~-._' + chr(39))}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is None:
        body = HTTP_HEAD % len(payload) + payload
        head.append("Content-Type: application/http; msgtype=response")
    else:
        body = b""
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Payload-Length: {len(payload)}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes, at: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of the record at an offset."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    body = raw[end + 4 : end + 4 + int(headers["Content-Length"])]
    return headers, body[body.index(b"\r\n\r\n") + 4 :] if body else b""


class BundleWriter:
    """Gathers records into frames; parts() are the file's bytes."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.rows: list[tuple[int, int, int, int]] = []

    def parts(self, records: Iterator[tuple[int | None, bytes]]) -> Iterator[bytes]:
        held: list[bytes] = []
        size = 0

        def close() -> bytes:
            plain = b"".join(held)
            frame = self.packer.compress(plain)
            self.frames.append((len(frame), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            held.clear()
            return frame

        for page_id, record in records:
            self.rows.append((page_id or 0, page_id is None, len(self.frames), size))
            held.append(record)
            size += len(record)
            if size >= FRAME_BYTES:
                yield close()
                size = 0
        if held:
            yield close()
        table = np.array(self.rows, dtype=MAP_ROW)
        mapped = self.packer.compress(table[np.argsort(table, order=("null", "page"), kind="stable")].tobytes())
        yield struct.pack("<II", SKIPPABLE_MAP, len(mapped)) + mapped
        # the record map counts as an entry without content, so that the entries' sizes add up to its end
        entries = [*self.frames, (len(mapped) + 8, 0, 0)]
        seek = b"".join(struct.pack("<III", *entry) for entry in entries) + struct.pack("<IBI", len(entries), 0x80, SEEK_MAGIC)
        yield struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek


class BundleReader:
    """Opens a bundle by its seek table."""

    def __init__(self, file) -> None:
        self.file = file
        file.seek(0, 2)
        end = file.tell()
        file.seek(end - 9)
        frames, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("not a seekable bundle")
        file.seek(end - 9 - 12 * frames)
        table = np.frombuffer(file.read(12 * frames), dtype="<u4").reshape(-1, 3).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(table[:, 0])]).tolist()
        self.frames = list(zip(starts[: frames - 1], table[: frames - 1].tolist(), strict=True))
        file.seek(starts[frames - 1])
        kind, size = struct.unpack("<II", file.read(8))
        if kind != SKIPPABLE_MAP:
            raise ValueError("the record map is missing")
        self.map = np.frombuffer(zstandard.ZstdDecompressor().decompress(file.read(size)), dtype=MAP_ROW)

    def frame(self, number: int) -> bytes:
        at, (size, plain_size, check) = self.frames[number]
        self.file.seek(at)
        plain = zstandard.ZstdDecompressor().decompress(self.file.read(size))
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} is damaged")
        return plain

    def get(self, page_id: int | None) -> list[tuple[dict[str, str], bytes]]:
        if page_id is None:
            rows = self.map[self.map["null"] == 1]
        else:
            known = self.map["page"][self.map["null"] == 0]
            rows = self.map[np.searchsorted(known, page_id, "left") : np.searchsorted(known, page_id, "right")]
        return [parse_record(self.frame(int(row["frame"])), int(row["offset"])) for row in rows]

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        order = np.argsort(self.map, order=("frame", "offset"))
        at, plain = -1, b""
        for row in self.map[order]:
            if row["frame"] != at:
                at, plain = row["frame"], self.frame(int(row["frame"]))
            yield parse_record(plain, int(row["offset"]))


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, part = SharedFiles(folder), TaskContext.get().partitionId()

    def records() -> Iterator[tuple[int | None, bytes]]:
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                yield page_id, build_record(page_id, url, (html or "").encode(), refers_to)

    source, number = records(), 0
    pending = next(source, None)
    while pending is not None:

        def upto() -> Iterator[tuple[int | None, bytes]]:
            nonlocal pending
            size = 0
            while pending is not None and size < BUNDLE_BYTES:
                size += len(pending[1])
                yield pending
                pending = next(source, None)

        writer, name = BundleWriter(), f"bundle-{part:06d}-{number:04d}.warc.zst"
        files.write(name, writer.parts(upto()))
        yield pa.RecordBatch.from_pylist([{"bundle": name, "records": len(writer.rows)}], schema=pa.schema([("bundle", pa.string()), ("records", pa.int64())]))
        number += 1


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files = SharedFiles(folder)
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows: list[dict] = []
            with files.open(name) as file:
                for headers, payload in BundleReader(file):
                    kind = headers["WARC-Type"]
                    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), len(payload)
                    if kind == "revisit":
                        size = int(headers["X-Payload-Length"])
                    elif base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                    url = headers.get("WARC-Target-URI")
                    rows.append({"page_id": page_of(headers["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None, "url": url if url is None else unquote(url)})
                    if len(rows) >= 20_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=ROWS_ARROW)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=ROWS_ARROW)


def write_bundles(spark: SparkSession, pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> list[str]:
    """Writes all pages; returns the bundles' names, one short row per bundle."""
    small_batches(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    large = keyed.where(F.octet_length("html") >= min_revisit) if min_revisit else keyed
    shared = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first_id")
    told = keyed.join(shared, "digest", "left").select("page_id", "url", "html", F.expr("case when first_id is not null and not (page_id <=> first_id) then first_id end").alias("refers_to"))
    return sorted(row.bundle for row in told.mapInArrow(lambda batches: _write(batches, folder), BUNDLES).collect())


def read_bundles(spark: SparkSession, folder: str, bundles: list[str]) -> DataFrame:
    listed = spark.createDataFrame([(name,) for name in bundles], "bundle string")
    return listed.repartition(max(1, len(bundles))).mapInArrow(lambda batches: _read(batches, folder), ROWS)


def archive_pages(spark: SparkSession, pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """One row per page, read from the bundles: page_id, payload_bytes, payload_digest, record_type, refers_to, url."""
    folder = shared_folder(spark, "warc")
    return read_bundles(spark, folder, write_bundles(spark, pages, folder, min_revisit))
