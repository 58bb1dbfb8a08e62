"""Token counts from pre-token frequencies; no ids are made.

Each task gathers whole texts into blocks of about BLOCK_BYTES. A block keeps, in one file of the shared
folder, its documents' pre-token frequencies as a sparse matrix over the block's own dictionary. The
dictionaries are dealt by a hash of the pre-token into buckets, where the pieces of each distinct pre-token
are counted once; the counts go back to the blocks as arrays, and each document's total is the product of its
frequencies with them. What is shuffled is one entry per distinct pre-token and block, so a pre-token that a
third of all texts hold costs no more than any other. A block's file is a function of its input split, so a
task that is run again leaves the same file.

Texts are split at spaces and newlines before the library's own normaliser and pre-tokeniser see each distinct
word; neither of them joins or looks across white space. Added tokens' strings inside texts count as one
token each, as in the library's default.

Null and empty texts have no tokens and no bytes; repeated rows and null ids give a row each. A text of any length is
read whole and stands in one block, which it may make larger than others. Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waymark.llm.common import SharedFiles, shared_folder, small_batches

BLOCK_BYTES = 16 << 20
#: Words and pre-tokens that a worker remembers between blocks and buckets.
REMEMBERED = 400_000

DEALT = T.StructType([T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("payload", T.BinaryType())])
ROWS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
DEALT_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])


class PreTokens:
    """The library's pre-tokens of words, and their pieces."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.pre, self.model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.words: dict[str, tuple[str, ...]] = {}
        self.pieces: dict[str, int] = {}

    def of_word(self, word: str) -> tuple[str, ...]:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            clean = self.normalizer.normalize_str(word) if self.normalizer else word
            found = self.words[word] = tuple(piece for piece, _ in self.pre.pre_tokenize_str(clean))
        return found

    def count(self, token: str) -> int:
        found = self.pieces.get(token)
        if found is None:
            if len(self.pieces) >= REMEMBERED:
                self.pieces.clear()
            found = self.pieces[token] = len(self.model.tokenize(token))
        return found


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


class _Numbers(dict):
    """Numbers keys in the order they first come."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def _planes(values: np.ndarray) -> bytes:
    """32-bit values by byte plane, which compress well as most are small."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _save(sections: list[bytes]) -> Iterator[bytes]:
    packer = zstandard.ZstdCompressor(level=1)
    for raw in sections:
        small = packer.compress(raw)
        yield struct.pack("<Q", len(small)) + small


def _load(raw: bytes) -> list[bytes]:
    opener, at, out = zstandard.ZstdDecompressor(), 0, []
    while at < len(raw):
        (size,) = struct.unpack_from("<Q", raw, at)
        out.append(opener.decompress(raw[at + 8 : at + 8 + size]))
        at += 8 + size
    return out


def _block(ids: list[int | None], texts: list[str | None], sizes: list[int], tools: PreTokens, buckets: int) -> tuple[list[bytes], list[tuple[int, bytes]]]:
    """A block's file sections, and its dictionary by bucket."""
    numbers = _Numbers()
    number = numbers.__getitem__
    special, word_counts, flat = [], [], []
    for text in texts:
        marks = 0
        if text and tools.added and tools.added.search(text):
            marks = len(tools.added.findall(text))
            text = tools.added.sub(" ", text)
        words = list(map(number, filter(None, text.replace("\n", " ").split(" ")))) if text else []
        special.append(marks)
        word_counts.append(len(words))
        flat.append(words)
    words = np.fromiter(chain.from_iterable(flat), dtype=np.int64, count=sum(word_counts))
    dictionary = _Numbers()
    spans = [tuple(map(dictionary.__getitem__, tools.of_word(word))) for word in numbers]
    span_sizes = np.fromiter(map(len, spans), dtype=np.int64, count=len(spans))
    span_flat = np.fromiter(chain.from_iterable(spans), dtype=np.int64, count=int(span_sizes.sum()))
    span_starts = np.cumsum(span_sizes) - span_sizes
    # every word of every text, opened into its pre-tokens
    repeats = span_sizes[words]
    firsts = np.repeat(span_starts[words] - (np.cumsum(repeats) - repeats), repeats)
    tokens = span_flat[firsts + np.arange(len(firsts))]
    owner = np.repeat(np.repeat(np.arange(len(texts)), word_counts), repeats)
    width = max(1, len(dictionary))
    pairs, times = np.unique(owner * width + tokens, return_counts=True)
    rows, columns = np.divmod(pairs, width)
    steps = np.diff(columns, prepend=0)
    new_row = np.diff(rows, prepend=-1) != 0
    steps[new_row] = columns[new_row]
    of = np.array([zlib.crc32(token.encode()) % buckets for token in dictionary], dtype="<u4")
    names = np.array([0 if x is None else x for x in ids], dtype="<i8")
    nulls = np.array([x is None for x in ids], dtype=np.uint8)
    sections = [names.tobytes(), nulls.tobytes(), np.array(sizes, dtype="<i8").tobytes(), np.array(special, dtype="<i8").tobytes(), _planes(np.bincount(rows, minlength=len(texts))), _planes(steps), _planes(times), _planes(of)]
    held: dict[int, list[str]] = {}
    for token, bucket in zip(dictionary, of.tolist(), strict=True):
        held.setdefault(bucket, []).append(token)
    held.setdefault(0, [])
    return sections, [(bucket, zlib.compress("\n".join(part).encode(), 1)) for bucket, part in held.items()]


def _gather(batches: Iterator[pa.RecordBatch], folder: str, path: str, buckets: int) -> Iterator[pa.RecordBatch]:
    tools, files = pre_tokens(path), SharedFiles(folder)
    block = TaskContext.get().partitionId() << 24
    ids: list = []
    texts: list = []
    sizes: list[int] = []

    def flush() -> pa.RecordBatch:
        nonlocal block
        sections, dealt = _block(ids, texts, sizes, tools, buckets)
        name = xxhash.xxh3_64_intdigest(b"".join(sections), seed=block) - (1 << 63)  # another content gets another file
        files.write(f"block-{name}", _save(sections))
        out = pa.RecordBatch.from_arrays([pa.array([name] * len(dealt), pa.int64()), pa.array([b for b, _ in dealt], pa.int32()), pa.array([p for _, p in dealt], pa.binary())], schema=DEALT_ARROW)
        block += 1
        for held in (ids, texts, sizes):
            held.clear()
        return out

    total = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        for number, text, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), lengths, strict=True):
            ids.append(number)
            texts.append(text)
            sizes.append(size)
            total += size
            if total >= BLOCK_BYTES:
                yield flush()
                total = 0
    if ids:
        yield flush()


def _pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tools = pre_tokens(path)
    for batch in batches:
        out = []
        for payload in batch.column(2).to_pylist():
            joined = zlib.decompress(payload).decode()
            counts = list(map(tools.count, joined.split("\n"))) if joined else []
            out.append(zlib.compress(np.array(counts, dtype="<u4").tobytes(), 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], schema=DEALT_ARROW)


def _totals(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    files = SharedFiles(folder)

    def finish(block: int, parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        with files.open(f"block-{block}") as file:
            names, nulls, sizes, special, row_sizes, steps, times, of = _load(file.read())
        buckets, row_sizes = _unplanes(of), _unplanes(row_sizes).astype(np.int64)
        pieces = np.zeros(len(buckets), dtype=np.int64)
        order = np.argsort(buckets, kind="stable")
        cuts = np.searchsorted(buckets[order], sorted(parts), side="left")
        asked = dict(zip(*(x.tolist() for x in np.unique(buckets, return_counts=True)), strict=True))
        if any(len(parts.get(bucket, ())) != n for bucket, n in asked.items()):
            raise RuntimeError(f"block {block}: the counts are not those of its pieces; its rows came in another order when a task ran again")
        for bucket, cut in zip(sorted(parts), cuts.tolist(), strict=True):
            pieces[order[cut : cut + len(parts[bucket])]] = parts[bucket]
        steps = _unplanes(steps).astype(np.int64)
        ends = np.cumsum(row_sizes)
        running = np.cumsum(steps)
        filled = np.flatnonzero(row_sizes)
        before = np.zeros(len(row_sizes), dtype=np.int64)
        before[filled[1:]] = running[(ends - row_sizes)[filled[1:]] - 1] if len(filled) else 0
        columns = running - np.repeat(before, row_sizes)
        weights = np.concatenate([[0], np.cumsum(pieces[columns] * _unplanes(times))])
        totals = weights[ends] - weights[ends - row_sizes] + np.frombuffer(special, dtype="<i8")
        return pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(names, dtype="<i8"), mask=np.frombuffer(nulls, dtype=np.uint8).astype(bool)), pa.array(np.frombuffer(sizes, dtype="<i8")), pa.array(totals), pa.array(totals > limit)],
            names=ROWS.names,
        )

    current, parts = None, {}
    for batch in batches:
        for block, bucket, payload in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if block != current and current is not None:
                yield finish(current, parts)
                parts = {}
            current = block
            parts[bucket] = np.frombuffer(zlib.decompress(payload), dtype="<u4")
    if current is not None:
        yield finish(current, parts)


def count_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than limit tokens)."""
    small_batches(spark)
    folder = shared_folder(spark, "token-counts")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(lambda batches: _gather(batches, folder, tokenizer, buckets), DEALT)
    counted = dealt.repartition(buckets, "bucket").mapInArrow(lambda batches: _pieces(batches, tokenizer), DEALT)
    back = counted.repartition(buckets, "block").sortWithinPartitions("block")
    return back.mapInArrow(lambda batches: _totals(batches, folder, limit), ROWS)
