"""Exact repeated-substring removal by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else too, in the same text or another.

1. Each text's strings are owned by their anchors (see anchors). The distinct anchor grams of each block of
   rows are dealt by hash and counted; grams that occur once are dropped, with the strings they own.
2. For each live anchor the suffix from its first string's start, as far as its last string's end, is an entry
   under the anchor's gram. Entries are sorted into runs; equal ones become one with a list of places. Runs are
   front-coded (length shared with the entry before, and the rest), cut by ranges of the gram's hash, exchanged,
   and merged by a loser tree that keeps each contender's common prefix with the last winner: it compares only
   where two prefixes are equally long, and only from there on.
3. An entry that comes twice is repeated wholly, and what it shares with a neighbour in the merged order
   repeats at its starts. What is left of entries of one gram is sorted by the suffixes from the anchor and by
   the reversed prefixes up to it; only starts that both orders allow are compared as whole strings. Strings
   can only be equal if their anchors are, so no other entries need a comparison.

No text is shuffled but for live entries: rows are addressed by file and row, what a block of rows has to know
is written to a file of the shared folder, and the scan that needs it reads it there. Every block has its files, if need be
empty ones, so a file that is missing is an error and never read as "nothing repeats". A gram or passage that a
third of all rows hold costs one entry per block in step 1 and one per run in step 2. There are as many buckets as
the texts' bytes need for BUCKET_BYTES each.

The distinct entries of one gram stand in one task, so a gram of more than HOT occurrences, as of a sentence that very
many texts have between different neighbours, is split. A string is longer than its gram by some bytes to the left
and some to the right; by how many to the right parts them in CLASSES, and strings of a class agree in the bytes to
either side that all of the class have. Entries of a hot gram stand under the hashes of these bytes, once for each class,
and equal strings meet in theirs.

Null and empty texts have nothing to remove; texts shorter than LENGTH stay whole, their strings match nothing;
repeated rows and null ids give a row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.anchors import anchors
from waymark.llm.blocks import Kept, addressed, keep_by_block, on_files
from waymark.llm.common import grouped, shared_folder, small_batches, written

LENGTH = 200
#: Bytes of entries that are sorted into one run.
RUN_BYTES = 32 << 20
HEAD = 8
#: Bytes of texts for each bucket of the exchanges.
BUCKET_BYTES = 48 << 20
#: Occurrences of a gram, of which a block of rows counts 65,535 at most, from which its entries are split, and into how many classes.
HOT, CLASSES = 4096, 4

DEALT = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("block", T.LongType()), T.StructField("payload", T.BinaryType())])
DEALT_ARROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())])
PLACE = np.dtype([("block", "<i8"), ("row", "<u4"), ("start", "<u4")])
LIVE = np.dtype([("gram", "<u8"), ("hot", "u1")])
SPAN = np.dtype([("row", "<u4"), ("start", "<u4"), ("end", "<u4")])


def gram_of(length: int) -> int:
    return max(1, length // 2 + 4) if length > 16 else max(1, length // 2)


def _raw(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [text or b"" for text in batch.column(column).cast(pa.binary()).to_pylist()]


def _post_grams(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each block's distinct grams by bucket, and how often it has them."""
    current, held = None, []

    def flush() -> pa.RecordBatch | None:
        if not held:
            return None
        grams, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        if not len(grams):
            return None
        cuts = _cut(grams, buckets)
        rows = []
        for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                rows.append({"bucket": bucket, "block": current, "payload": grams[a:b].astype("<u8").tobytes() + np.minimum(counts[a:b], 65_535).astype("<u2").tobytes()})
        return pa.RecordBatch.from_pylist(rows, schema=DEALT_ARROW)

    for batch in batches:
        for block, text in zip(batch.column(0).to_pylist(), _raw(batch, 2), strict=True):
            if block != current:
                if (out := flush()) is not None:
                    yield out
                current = block
            held.append(anchors(np.frombuffer(text, dtype=np.uint8), length, gram_of(length))[1])
    if (out := flush()) is not None:
        yield out


def _cut(values: np.ndarray, buckets: int) -> list[int]:
    """Where sorted hashes are cut into equal ranges of 64-bit hashes."""
    starts = np.array([(k << 64) // buckets for k in range(buckets)], dtype=np.uint64)
    return [*np.searchsorted(values, starts).tolist(), len(values)]


def _live_grams(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """Of a bucket's grams, for each block, those that occur twice over all, and whether more than hot times."""
    for bucket, rows in grouped(batches):
        blocks, grams, times = [], [], []
        for block, payload in rows:
            n = len(payload) // 10
            blocks.append(block)
            grams.append(np.frombuffer(payload, "<u8", n))
            times.append(np.frombuffer(payload, "<u2", n, 8 * n))
        every = np.concatenate(grams)
        known, place = np.unique(every, return_inverse=True)
        totals = np.bincount(place, weights=np.concatenate(times), minlength=len(known))[place]
        at, out = 0, []
        for block, part in zip(blocks, grams, strict=True):
            mine = totals[at : at + len(part)]
            at += len(part)
            chosen = np.empty(int((mine > 1).sum()), dtype=LIVE)
            chosen["gram"], chosen["hot"] = part[mine > 1], mine[mine > 1] > hot
            if len(chosen):
                out.append({"bucket": bucket, "block": block, "payload": chosen.tobytes()})
        yield pa.RecordBatch.from_pylist(out, schema=DEALT_ARROW)


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """The length of the common prefix of strings that agree up to start."""
    most = min(len(a), len(b))
    step = 8
    while start < most:
        x, y = a[start : start + step], b[start : start + step]
        if x != y:
            n = min(len(x), len(y))
            apart = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
            return start + n - (apart.bit_length() + 7) // 8
        start += len(x)
        step *= 4
    return most


def front_code(entries: list[tuple[bytes, int, np.ndarray]]) -> bytes:
    """Sorted distinct entries (string, anchor's place in it, places) as shared lengths, rests and places."""
    last, shared, rests = b"", [], []
    for text, _, _ in entries:
        n = common_prefix(last, text, 0)
        shared.append(n)
        rests.append(text[n:])
        last = text
    heads = np.array([shared, [len(x) for x in rests], [a for _, a, _ in entries]], dtype="<u2")
    counts = np.array([len(p) for _, _, p in entries], dtype="<u4")
    places = np.concatenate([p for _, _, p in entries])
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<II", len(entries), len(places)) + heads.tobytes() + counts.tobytes() + places.tobytes() + b"".join(rests))


def read_run(payload: bytes) -> Iterator[tuple[bytes, int, int, np.ndarray]]:
    """Entries (string, prefix shared with the one before, anchor, places) of a front-coded run."""
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, m = struct.unpack_from("<II", raw)
    heads = np.frombuffer(raw, "<u2", 3 * n, 8).reshape(3, n).tolist()
    counts = np.frombuffer(raw, "<u4", n, 8 + 6 * n).tolist()
    places = np.frombuffer(raw, PLACE, m, 8 + 10 * n)
    at, place, text = 8 + 10 * n + PLACE.itemsize * m, 0, b""
    for shared, own, anchor, count in zip(*heads, counts, strict=True):
        text = text[:shared] + raw[at : at + own]
        at += own
        yield text, shared, anchor, places[place : place + count]
        place += count


class LoserTree:
    """Merges runs of strings; yields (string, prefix shared with the string before, run's item).

    Every contender carries the length it shares with the last winner. Of two, the one that shares more comes
    first; only equal lengths need a comparison, from that length on, and it gives the loser's new length.
    """

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.items: list[tuple | None] = [next(run, None) for run in runs] + [None] * (self.size - len(runs))
        self.shared = [0] * self.size
        self.losers = [0] * self.size
        self.compared = 0
        self.winner = self._build(1)

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs' heads."""
        x, y = self.items[a], self.items[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        m, n = self.shared[a], self.shared[b]
        if m != n:
            return (a, b) if m > n else (b, a)
        s, t = x[0], y[0]
        self.compared += 1
        if s == t:
            self.shared[b] = len(s)
            return a, b
        n = common_prefix(s, t, m)
        if n == len(s) or n < len(t) and s[n] < t[n]:
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[bytes, int, tuple]]:
        items, shared, losers, play = self.items, self.shared, self.losers, self._play
        winner, first = self.winner, True
        while (item := items[winner]) is not None:
            yield item[0], 0 if first else shared[winner], item
            first = False
            items[winner] = follower = next(self.runs[winner], None)
            if follower is not None:
                shared[winner] = follower[1]
            node = (winner + self.size) >> 1
            while node:
                winner, losers[node] = play(winner, losers[node])
                node >>= 1


def class_heads(head: bytes, text: bytes, at: int, first: int, last: int, gram: int, length: int) -> Iterator[bytes]:
    """The heads under which an entry of a hot gram stands: hashes of the gram and of the bytes that a class of strings has about it.

    The class number k has the strings with k * step to (k + 1) * step - 1 bytes behind the gram; an entry's strings
    start from first to last.
    """
    spare = length - gram
    step = -(-(spare + 1) // CLASSES)
    least, most = spare - (at - first), spare - (at - last)
    for k in range(least // step, most // step + 1):
        left, right = max(0, spare - (k + 1) * step + 1), k * step
        around = text[at - left : at] + b"|" + text[at + gram : at + gram + right]
        yield hashlib.blake2b(head + bytes([k]) + around, digest_size=HEAD).digest()


def _sort_runs(batches: Iterator[pa.RecordBatch], folder: str, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Sorted front-coded runs of live entries, by bucket."""
    live, gram = Kept(folder, "live-", LIVE), gram_of(length)
    texts: list[bytes] = []
    owns: list[int] = []
    places: list[tuple[int, int, int]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(texts)), key=texts.__getitem__)
        refs = np.array(places, dtype=PLACE)[order]
        distinct: list[tuple[bytes, int, np.ndarray]] = []
        at = 0
        while at < len(order):
            text, upto = texts[order[at]], at + 1
            while upto < len(order) and texts[order[upto]] == text:
                upto += 1
            distinct.append((text, owns[order[at]], refs[at:upto]))
            at = upto
        cuts = _cut(np.array([int.from_bytes(text[:HEAD], "big") for text, _, _ in distinct], dtype=np.uint64), buckets)
        texts.clear()
        owns.clear()
        places.clear()
        for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                yield pa.RecordBatch.from_pylist([{"bucket": bucket, "block": 0, "payload": front_code(distinct[a:b])}], schema=DEALT_ARROW)

    for batch in batches:
        for block, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _raw(batch, 2), strict=True):
            known = live.of(block)
            if len(text) < length or not len(known):
                continue
            where, grams, first, last = anchors(np.frombuffer(text, dtype=np.uint8), length, gram)
            slots = np.searchsorted(known["gram"], grams)
            slots[slots == len(known)] = 0
            hits = np.flatnonzero(known["gram"][slots] == grams)
            for at, value, hot, a, b in zip(where[hits].tolist(), grams[hits].tolist(), known["hot"][slots[hits]].tolist(), first[hits].tolist(), last[hits].tolist(), strict=True):
                head = value.to_bytes(HEAD, "big")
                for key in class_heads(head, text, at, a, b, gram_of(length), length) if hot else (head,):
                    texts.append(key + text[a : b + length])
                    owns.append(at - a)
                    places.append((block, row, a))
                    size += b + length - a + 100
            if size >= RUN_BYTES:
                yield from flush()
                size = 0
    if texts:
        yield from flush()


def _longest_shared(texts: list[bytes]) -> list[int]:
    """For each string, the longest prefix that it shares with any other, from its neighbours in sorted order."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    out, last = [0] * len(texts), 0
    for at, number in enumerate(order):
        ahead = common_prefix(texts[number], texts[order[at + 1]], 0) if at + 1 < len(order) else 0
        out[number] = max(last, ahead)
        last = ahead
    return out


def repeated_starts(entries: list[tuple[bytes, int, int]], shared: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each distinct entry of one gram, its ranges (first, last) of starts whose strings come twice.

    Entries are (string, anchor's place, number of places) in sorted order; shared[i] is the prefix that the
    i-th has in common with the one before. What two neighbours share repeats at its starts. A string elsewhere
    in an entry can only come again if some other entry agrees with it to the left of the anchor and some other
    to the right; the few starts for which that holds are compared at each distance from the anchor.
    """
    count = len(entries)
    ends = [len(text) - HEAD - length for text, _, _ in entries]
    if count == 1:
        return [[(0, ends[0])] if entries[0][2] > 1 else []]
    known = [ends[i] if entries[i][2] > 1 else min(ends[i], max(shared[i] if i else 0, shared[i + 1] if i + 1 < count else 0) - HEAD - length) for i in range(count)]
    out = [[(0, upto)] if upto >= 0 else [] for upto in known]
    if all(upto == end for upto, end in zip(known, ends, strict=True)):
        return out
    right = _longest_shared([text[HEAD + anchor :] for text, anchor, _ in entries])
    left = _longest_shared([text[HEAD : HEAD + anchor][::-1] for text, anchor, _ in entries])
    ranges = [(max(0, anchor - left[i]), min(ends[i], anchor + right[i] - length)) for i, (_, anchor, _) in enumerate(entries)]
    open_at = {k - entries[i][1] for i, (a, b) in enumerate(ranges) for k in range(max(a, known[i] + 1), b + 1)}
    marked: dict[int, list[int]] = {}
    for distance in sorted(open_at):
        strings: dict[bytes, int] = {}
        for i, (text, anchor, _) in enumerate(entries):
            k = anchor + distance
            if not ranges[i][0] <= k <= ranges[i][1]:
                continue
            string = text[HEAD + k : HEAD + k + length]
            first = strings.setdefault(string, i)
            if first != i:
                for number in (first, i):
                    start = entries[number][1] + distance
                    if start > known[number] and (number not in marked or marked[number][-1] != start):
                        marked.setdefault(number, []).append(start)
    for number, starts in marked.items():
        a = b = starts[0]
        for k in starts[1:]:
            if k != b + 1:
                out[number].append((a, b))
                a = k
            b = k
        out[number].append((a, b))
    return out


def _merge_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Merges a bucket's runs; gives the repeated byte ranges by block of rows."""
    for bucket, rows in grouped(batches):
        spans: dict[int, list[np.ndarray]] = {}

        def close(entries: list[tuple[bytes, int, list[np.ndarray]]], shared: list[int]) -> None:
            sizes = [sum(map(len, parts)) for _, _, parts in entries]
            if sizes == [1]:
                return
            found = repeated_starts([(text, anchor, n) for (text, anchor, _), n in zip(entries, sizes, strict=True)], shared, length)
            for (_, _, parts), ranges in zip(entries, found, strict=True):
                for places in parts if ranges else ():
                    for a, b in ranges:
                        made = np.empty(len(places), dtype=SPAN)
                        made["row"], made["start"], made["end"] = places["row"], places["start"] + a, places["start"] + (b + length)
                        if len(places) == 1:
                            spans.setdefault(int(places["block"][0]), []).append(made)
                        else:
                            for block in np.unique(places["block"]).tolist():
                                spans.setdefault(block, []).append(made[places["block"] == block])

        group: list[tuple[bytes, int, list[np.ndarray]]] = []
        lengths: list[int] = []
        for text, shared, item in LoserTree([read_run(payload) for _, payload in rows]):
            if group and shared == len(text) == len(group[-1][0]):
                group[-1][2].append(item[3])
                continue
            if group and shared < HEAD:
                close(group, lengths)
                group, lengths = [], []
            group.append((text, item[2], [item[3]]))
            lengths.append(shared)
        if group:
            close(group, lengths)
        out = [{"bucket": bucket, "block": block, "payload": np.concatenate(found).tobytes()} for block, found in spans.items()]
        yield pa.RecordBatch.from_pylist(out, schema=DEALT_ARROW)


def _covered(found: np.ndarray, row: int) -> list[tuple[int, int]]:
    """A row's maximal removed ranges; found is sorted by row and start."""
    a, b = np.searchsorted(found["row"], [row, row + 1]).tolist()
    out: list[tuple[int, int]] = []
    for start, end in zip(found["start"][a:b].tolist(), found["end"][a:b].tolist(), strict=True):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remaining(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for start, end in ranges:
        parts.append(text[at:start])
        at = end
    parts.append(text[at:])
    return b"".join(parts)


def find_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> str:
    """Runs the sort; returns the folder whose span files the rows' blocks read."""
    folder = shared_folder(spark, "suffixes")
    rows = addressed(docs, "text")
    blocks = written(spark, rows.groupBy("block").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")), "suffix-blocks")
    nothing = blocks.select("block", F.lit(b"").alias("payload"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(blocks.agg(F.sum("bytes")).first()[0] or 0) // BUCKET_BYTES))
    dealt = lambda made, key: made.repartition(buckets, key).sortWithinPartitions(key)
    grams = rows.mapInArrow(lambda batches: _post_grams(batches, length, buckets), DEALT)
    live = dealt(grams, "bucket").mapInArrow(lambda batches: _live_grams(batches, hot), DEALT).select("block", "payload")
    dealt(live.unionByName(nothing), "block").mapInArrow(lambda batches: keep_by_block(batches, folder, "live-", LIVE, ["gram", "hot"]), "block long, n long").agg(F.sum("n")).collect()
    runs = rows.mapInArrow(lambda batches: _sort_runs(batches, folder, length, buckets), DEALT)
    spans = dealt(runs, "bucket").mapInArrow(lambda batches: _merge_runs(batches, length), DEALT).select("block", "payload")
    dealt(spans.unionByName(nothing), "block").mapInArrow(lambda batches: keep_by_block(batches, folder, "span-", SPAN, ["row", "start", "end"]), "block long, n long").agg(F.sum("n")).collect()
    return folder


def _each_row(batches: Iterator[pa.RecordBatch], folder: str, make: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept = Kept(folder, "span-", SPAN)
    for batch in batches:
        rows = [make(text, _covered(kept.of(block), row)) for block, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _raw(batch, 2), strict=True)]
        made = [pa.array([row[k] for row in rows], schema.field(k).type) for k in range(len(rows[0]) if rows else 0)]
        if rows:
            yield pa.RecordBatch.from_arrays([*made, *batch.columns[3:]], schema=schema)


def _digest(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, int, str]:
    return len(text), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(remaining(text, ranges)).hexdigest()


def repeat_digests(spark: SparkSession, docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    small_batches(spark)
    docs = on_files(spark, docs, "suffix-docs")
    folder = find_repeats(spark, docs, length, hot)
    schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("doc_id", pa.int64())])
    rows = addressed(docs, "text", "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    made = rows.mapInArrow(lambda batches: _each_row(batches, folder, _digest, schema), "n_bytes long, n_removed long, n_spans long, kept_sha256 string, doc_id long")
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _rest(text: bytes, ranges: list[tuple[int, int]]) -> tuple[str, int]:
    return remaining(text, ranges).decode(errors="ignore"), sum(b - a for a, b in ranges)


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents' columns with repeated bytes taken out of text, and n_removed.

    Bytes of a character that is cut in two go with the cut; a text from which nothing is removed is unchanged.
    """
    small_batches(spark)
    docs = on_files(spark, docs, "suffix-docs")
    folder = find_repeats(spark, docs, length)
    others = [field for field in docs.schema.fields if field.name != "text"]
    rows = addressed(docs, "text", *(F.col(f"`{field.name}`").alias(f"c{k}") for k, field in enumerate(others)))
    made_type = T.StructType([T.StructField("rest", T.StringType()), T.StructField("n_removed", T.LongType()), *(T.StructField(f"c{k}", field.dataType) for k, field in enumerate(others)), T.StructField("was", T.StringType())])
    inputs = rows.select("block", "row", "text", *(f"c{k}" for k in range(len(others))), F.col("text").alias("was"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed = pa.schema([("rest", pa.string()), ("n_removed", pa.int64()), *((batch.schema.field(k).name, batch.schema.field(k).type) for k in range(3, batch.num_columns))])
            yield from _each_row(iter([batch]), folder, _rest, fixed)

    made = inputs.mapInArrow(work, made_type)
    back = {field.name: F.col(f"c{k}") for k, field in enumerate(others)} | {"text": F.when(F.col("n_removed") > 0, F.col("rest")).otherwise(F.col("was"))}
    return made.select(*(back[name].alias(name) for name in docs.columns), "n_removed")
