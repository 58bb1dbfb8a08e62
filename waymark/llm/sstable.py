"""Token ids in sorted-string-table shards.

A shard holds documents in ascending key order::

    magic | block ... | index | bloom | footer

Keys are nine bytes, a null flag and the big-endian id with its sign bit flipped, so bytes sort as ids do and a
null id comes first. A block keeps entries (shared prefix, own suffix, value length, suffix, value); it is
compressed with Zstandard where that helps, and followed by its CRC. The sparse index has each block's last
key and place, the Bloom filter ten bits a key. A lookup reads footer, filter and index, then one block.
Values are ids as little-endian unsigned 16- or 32-bit integers, as the shard's flag says.

Documents are range-partitioned and sorted by id; each task writes one shard under a temporary name and
renames it, so a task that is run again leaves the same shard. The driver receives one short row per shard.
Null texts count as empty; rows that repeat are stored each, in the order of their texts' bytes. A text of any
length is one value, in a block of its own if it fills one. Extra columns are ignored, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.bpe import byte_bpe
from waymark.llm.common import SharedFiles, shared_folder, small_batches

MAGIC = b"WMSST\x00\x01\n"
BLOCK_BYTES = 256 << 10
BLOOM_BITS, BLOOM_HASHES = 10, 7
FOOTER = struct.Struct("<QQQQQQB8s")

SHARDS = T.StructType([T.StructField("shard", T.StringType()), T.StructField("part", T.LongType()), T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType())])
ROWS = T.StructType([T.StructField(name, T.LongType()) for name in ("doc_id", "start", "n_tokens", "ids_crc32")])


def key_of(doc_id: int | None) -> bytes:
    return b"\x00" * 9 if doc_id is None else b"\x01" + (doc_id + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return int.from_bytes(key[1:], "big") - (1 << 63) if key[0] else None


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _read_varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _bloom_places(keys: list[bytes], bits: int) -> np.ndarray:
    first = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
    second = np.array([xxhash.xxh64_intdigest(k, seed=1) | 1 for k in keys], dtype=np.uint64)
    return (first[:, None] + second[:, None] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(bits)


class ShardWriter:
    """Yields the bytes of a shard for entries that come in key order."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.keys: list[bytes] = []
        self.index: list[tuple[bytes, int, int, int]] = []
        self.tokens = 0

    def parts(self, entries: Iterator[tuple[bytes, bytes]]) -> Iterator[bytes]:
        packer = zstandard.ZstdCompressor(level=1)
        yield MAGIC
        at, block, size, last = len(MAGIC), [], 0, b""

        def close() -> bytes:
            nonlocal at, size
            raw = b"".join(block)
            small = packer.compress(raw)
            body = b"\x01" + small if len(small) < len(raw) else b"\x00" + raw
            body += struct.pack("<I", zlib.crc32(body))
            self.index.append((last, at, len(body), len(self.keys)))
            at += len(body)
            block.clear()
            size = 0
            return body

        for key, value in entries:
            shared = 0
            if block:
                while shared < len(key) and key[shared] == last[shared]:
                    shared += 1
            block += (_varint(shared), _varint(len(key) - shared), _varint(len(value)), key[shared:], value)
            self.keys.append(key)
            self.tokens += len(value) // self.width
            size += len(value) + len(key)
            last = key
            if size >= BLOCK_BYTES:
                yield close()
        if block:
            yield close()
        index_at = at
        index = b"".join(_varint(len(k)) + k + _varint(o) + _varint(n) + _varint(e) for k, o, n, e in self.index)
        yield index
        bits = max(64, BLOOM_BITS * len(self.keys))
        bloom = np.zeros((bits + 7) // 8, dtype=np.uint8)
        if self.keys:
            places = np.unique(_bloom_places(self.keys, bits).ravel())
            np.bitwise_or.at(bloom, (places >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (places & np.uint64(7)).astype(np.uint8)))
        yield bloom.tobytes()
        yield FOOTER.pack(index_at, len(index), index_at + len(index), bits, len(self.keys), self.tokens, self.width, MAGIC)


class ShardReader:
    """Reads a shard in order, or looks one key up."""

    def __init__(self, file) -> None:
        self.file = file
        file.seek(0, 2)
        end = file.tell()
        file.seek(end - FOOTER.size)
        self.index_at, self.index_len, self.bloom_at, self.bits, self.docs, self.tokens, self.width, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        file.seek(self.index_at)
        raw, at = file.read(self.index_len), 0
        self.last: list[bytes] = []
        self.places: list[tuple[int, int]] = []
        while at < len(raw):
            n, at = _read_varint(raw, at)
            self.last.append(raw[at : at + n])
            offset, at = _read_varint(raw, at + n)
            length, at = _read_varint(raw, at)
            _, at = _read_varint(raw, at)
            self.places.append((offset, length))
        self._bloom: bytes | None = None

    def ids(self, value: bytes) -> np.ndarray:
        return np.frombuffer(value, dtype="<u2" if self.width == 2 else "<u4").astype("<u4")

    def block(self, number: int) -> Iterator[tuple[bytes, bytes]]:
        offset, length = self.places[number]
        self.file.seek(offset)
        body = self.file.read(length)
        if zlib.crc32(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError(f"block {number} is damaged")
        raw = zstandard.ZstdDecompressor().decompress(body[1:-4]) if body[0] else body[1:-4]
        at, key = 0, b""
        while at < len(raw):
            shared, at = _read_varint(raw, at)
            own, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + own]
            at += own
            yield key, raw[at : at + size]
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for number in range(len(self.places)):
            yield from self.block(number)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """All values under an id: filter, binary search in the index, then the block (or blocks)."""
        key = key_of(doc_id)
        if self._bloom is None:
            self.file.seek(self.bloom_at)
            self._bloom = self.file.read((self.bits + 7) // 8)
        if not all(self._bloom[p >> 3] >> (p & 7) & 1 for p in _bloom_places([key], self.bits)[0].tolist()):
            return []
        found, number = [], bisect.bisect_left(self.last, key)
        while number < len(self.places):
            found += [self.ids(v) for k, v in self.block(number) if k == key]
            if self.last[number] > key:
                break
            number += 1
        return found


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = byte_bpe(path)
    width = 2 if len(encoder.begins) <= 1 << 16 and end_id < 1 << 16 else 4
    end = np.array([end_id], dtype="<u4").tobytes()
    part = TaskContext.get().partitionId()

    def entries() -> Iterator[tuple[bytes, bytes]]:
        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), encoder.encode_many(batch.column(1).to_pylist()), strict=True):
                raw += end
                yield key_of(number), raw if width == 4 else np.frombuffer(raw, dtype="<u4").astype("<u2").tobytes()

    source = entries()
    first = next(source, None)
    if first is None:
        return

    def all_entries() -> Iterator[tuple[bytes, bytes]]:
        yield first
        yield from source

    writer, name = ShardWriter(width), f"shard-{part:07d}.sst"
    SharedFiles(folder).write(name, writer.parts(all_entries()))
    yield pa.RecordBatch.from_pylist([{"shard": name, "part": part, "docs": len(writer.keys), "tokens": writer.tokens}], schema=pa.schema([("shard", pa.string()), ("part", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())]))


def write_shards(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> list[tuple[str, int, int]]:
    """Writes all documents; returns (shard, documents, tokens) in key order, one short row per shard."""
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    made = ordered.mapInArrow(lambda batches: _write(batches, folder, tokenizer, end_id), SHARDS).collect()
    return [(row.shard, row.docs, row.tokens) for row in sorted(made, key=lambda row: row.part)]


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files = SharedFiles(folder)
    for batch in batches:
        for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            columns: list[list] = [[], [], [], []]
            with files.open(shard) as file:
                reader = ShardReader(file)
                for key, value in reader:
                    ids = reader.ids(value)
                    for column, x in zip(columns, (id_of(key), start, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                        column.append(x)
                    start += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=ROWS.names)


def read_shards(spark: SparkSession, folder: str, shards: list[tuple[str, int, int]]) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens, ids_crc32, read from the files."""
    rows, start = [], 0
    for shard, _, tokens in shards:
        rows.append((shard, start))
        start += tokens
    listed = spark.createDataFrame(rows, "shard string, start long")
    return listed.repartition(max(1, len(rows))).mapInArrow(lambda batches: _read(batches, folder), ROWS)


def token_shards(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Writes the shards to a new shared folder and returns what they hold."""
    folder = shared_folder(spark, "sstable")
    return read_shards(spark, folder, write_shards(spark, docs, folder, tokenizer, end_id))
