"""Cost-balanced packing of token sequences.

A document's cost is estimated as linear * n + quadratic * n * n, the feed-forward and the attention share.
Within a pack of about PACK_TOKENS tokens, pieces go by descending cost to the sequence of lowest cost that
still has room; a piece that fits nowhere is cut at the largest room left. The capacities of a pack add up to
its tokens: full sequences and, for the last tokens, sequences whose lengths are powers of two, so nothing is
padded. A pack never leaves its task: no shuffle, no driver work, and memory bounded by the pack.

Null or empty texts are packed as their end id alone; rows that repeat, or have a null doc_id, are packed each
for itself. Pieces of equal cost go in order of their place, sequences of equal cost by number. Texts longer than a
sequence are cut; texts of any length are encoded whole. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waymark.llm.bpe import byte_bpe
from waymark.llm.common import small_batches

MAX_TOKENS = 2048
#: Tokens of a pack: 2,048 sequences, 16 MB of ids.
PACK_TOKENS = 4 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


def pack(lengths: list[int], capacity: int = MAX_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """Pieces (document index, start, length, sequence, offset) and the sequences' capacities."""
    total = sum(lengths)
    full, rest = divmod(total, capacity)
    room = np.array([capacity] * full + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1], dtype=np.int64)
    limits, cost = room.copy(), np.zeros(len(room))
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(document: int, start: int, length: int, sequence: int) -> None:
        pieces.append((document, start, length, sequence, int(limits[sequence] - room[sequence])))
        room[sequence] -= length
        cost[sequence] += linear * length + quadratic * length * length

    queue, next_full = [], 0
    for document, length in enumerate(lengths):
        whole = length // capacity
        for k in range(whole):  # as long as a sequence: alone in the next one
            put(document, k * capacity, capacity, next_full)
            next_full += 1
        if length % capacity:
            queue.append((-(length % capacity), document, whole * capacity))
    heapq.heapify(queue)
    while queue:
        negative, document, start = heapq.heappop(queue)
        length = -negative
        fits = np.flatnonzero(room >= length)
        if len(fits):
            put(document, start, length, int(fits[np.argmin(cost[fits])]))
            continue
        widest = int(np.argmax(room))
        part = int(room[widest])
        put(document, start, part, widest)
        heapq.heappush(queue, (-(length - part), document, start + part))
    return pieces, limits


def _packs(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder, end = byte_bpe(path), np.array([end_id], dtype="<u4").tobytes()
    partition = TaskContext.get().partitionId() if TaskContext.get() else 0
    sequence = partition << 32
    ids: list[bytes] = []
    names: list[int | None] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal sequence, held
        pieces, limits = pack([len(x) // 4 for x in ids], capacity)
        rows = [[], [], [], [], [], [], []]
        for document, start, length, where, offset in pieces:
            raw = ids[document]
            values = (names[document], start, length, zlib.crc32(memoryview(raw)[4 * start : 4 * (start + length)]), len(raw) // 4, sequence + where, offset)
            for column, value in zip(rows, values, strict=True):
                column.append(value)
        sequence += len(limits)
        ids.clear()
        names.clear()
        held = 0
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names=SCHEMA.names)

    for batch in batches:
        texts, numbers = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for number, raw in zip(numbers, encoder.encode_many(texts), strict=True):
            ids.append(raw + end)
            names.append(number)
            held += len(raw) // 4 + 1
            if held >= PACK_TOKENS:
                yield flush()
    if ids:
        yield flush()


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = MAX_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    sequence_id holds the task's number above bit 32; offset is gapless from 0 within a sequence.
    """
    small_batches(spark)
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _packs(batches, tokenizer, end_id, capacity), SCHEMA)
