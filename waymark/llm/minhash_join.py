"""Near-duplicate groups by an inverted join of MinHash signature coordinates.

1. Each text's set of word shingles gives its size, a 128-bit key of the whole set and a signature of
   COORDINATES minima. Rows with equal keys form a class, and from here on there is one row per class.
2. Classes are posted under each coordinate-value pair. A pair that one class alone has is dropped; the others are
   ordered by rarity, and of each class only the prefix stays in which any other class with MATCHES equal
   coordinates must share a posting: the COORDINATES - MATCHES + 1 rarest ones.
3. Groups: under its FREQUENT commonest pairs a class meets the bulk of a large group of copies. The member
   nearest to the list's consensus leads, and those with enough equal coordinates follow it; the best leaders of
   each class are confirmed on the full shingle sets, and confirmed links give components. This only saves work:
   what it misses is found next.
4. Merging: each posting list of the prefixes is merged, and members of one component skip each other. Where
   members of different components have MATCHES equal coordinates and sizes that allow the similarity, the two
   components are joined to a cluster. A list gives fewer rows than it has components, never its pairs.
5. Verdicts: in a cluster of several components, the members outside its largest one are held against all others,
   in blocks of BLOCK by BLOCK, on signatures first and then on full sets. So every pair that shares a posting,
   has MATCHES equal coordinates and lies in two components is decided on its full sets.

A posting carries one byte a coordinate: bytes of unequal minima are equal once in 256, which adds candidates
but loses none. Lists over CHUNK are cut; the members outside a list's largest component then go to each piece.
Inside a list, classes meet by 16-bit pairs of coordinates where that is less work than each with each: of
COORDINATES / 2 pairs, enough are equal that any COORDINATES - MATCHES + 1 of them hold an equal one.

Texts are not shuffled but for those whose pairs are decided: rows are addressed by file and place, what a block of
rows has to give is written to a file of the shared folder, and a scan picks it. Tables are removed when what is made
from them has been written. Components with very many members make hot join keys, which adaptive execution splits.
Tables that grow with the input are joined by exchange: Spark expects one element of an array, so a table of postings
under its limit for broadcasts by that measure can be a hundred times as large, which the driver would have to hold.
Only the tables of lists over CHUNK, a row for 8,192 postings or for one of their leaders, are left to Spark's choice.

A pair of Jaccard similarity 0.8 has fewer than 34 of 64 equal coordinates with a probability of 3e-7, and only
then, and if no third text links the two, is it lost.

Null and empty texts have no shingles and are linked with nothing. Rows that share a doc_id are one document,
whatever their texts. A row with a null doc_id is compared with nothing: its component_id is null and it is
kept. Texts of any length are read whole. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.blocks import Kept, addressed, keep_by_block, on_files
from waymark.llm.common import discard, exchanged, shared_folder, small_batches, written
from waymark.llm.components import components
from waymark.llm.shingles import shingle_sets

COORDINATES, MATCHES = 64, 34
FREQUENT, LEADERS, FOLLOWED = 3, 32, 2
CHUNK, BLOCK = 8192, 512
#: Lists up to this size are compared each with each, many lists at once.
SMALL = 24
BATCH_BYTES = 2 << 20
#: Rows of lists that are taken at once, but for longer lists.
ROWS_AT_ONCE = 20_000

_RNG = np.random.default_rng(7)
_FACTORS = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)

SIGNED = T.StructType([T.StructField("block", T.LongType()), T.StructField("row", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("minima", T.ArrayType(T.IntegerType())), T.StructField("sig", T.BinaryType())])
SIGNED_ARROW = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("minima", pa.list_(pa.int32())), ("sig", pa.binary())])
STARS = T.StructType([T.StructField("token", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("weight", T.LongType())])
EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of COORDINATES minima for each set; sets must not be empty."""
    out = np.empty((len(bounds) - 1, COORDINATES), dtype="<u4")
    for c in range(COORDINATES):
        out[:, c] = np.minimum.reduceat((values * _FACTORS[c] + _TERMS[c]) >> np.uint64(32), bounds[:-1])
    return out


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for at, size in enumerate(sizes):
        held += size
        if held >= BATCH_BYTES:
            yield start, at + 1
            start, held = at + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _sign(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(2).to_pylist()
        texts = [text or b"" for text in batch.column(3).cast(pa.binary()).to_pylist()]
        for a, b in _slices([len(text) for text in texts]):
            values, bounds = shingle_sets(texts[a:b], words)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            keys: list[bytes | None] = [None] * (b - a)
            minima: list[np.ndarray | None] = [None] * (b - a)
            sigs: list[bytes | None] = [None] * (b - a)
            if len(some):
                rows = signatures(values, np.append(bounds[some], len(values)))
                low = (rows & np.uint32(255)).astype(np.uint8)
                raw = values.tobytes()
                for k, row, sig in zip(some.tolist(), rows.view(np.int32), low, strict=True):
                    keys[k] = xxhash.xxh3_128_digest(raw[8 * bounds[k] : 8 * bounds[k + 1]])
                    minima[k], sigs[k] = row, sig.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(ids[a:b], pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(minima, pa.list_(pa.int32())), pa.array(sigs, pa.binary())], schema=SIGNED_ARROW)


def equal_counts(sigs: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Equal coordinates, row by row; one of the two may be a single row."""
    lanes = np.ascontiguousarray(sigs == other).view("<u8").sum(axis=1, dtype=np.uint64)  # eight lanes of at most eight
    return ((lanes * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def sizes_allow(n: np.ndarray, other: np.ndarray | int, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar enough."""
    return 100 * np.minimum(n, other) >= percent * np.maximum(n, other)


def _numpy(column: pa.Array) -> np.ndarray:
    if pa.types.is_binary(column.type):  # of COORDINATES bytes each
        start = int(np.frombuffer(column.buffers()[1], "<i4", 1, 4 * column.offset)[0]) if len(column) else 0
        return np.frombuffer(column.buffers()[2], np.uint8, COORDINATES * len(column), start).reshape(-1, COORDINATES) if len(column) else np.empty((0, COORDINATES), np.uint8)
    return column.to_numpy(zero_copy_only=False)


def whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of many whole lists at once; rows come in order of the first column, the list."""
    parts: list[list[np.ndarray]] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        parts.append([_numpy(c) for c in batch.columns])
        held += batch.num_rows
        if held < ROWS_AT_ONCE or parts[-1][0][-1] == parts[0][0][0]:
            continue
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        cut = int(np.flatnonzero(columns[0] != columns[0][-1])[-1]) + 1
        yield [c[:cut] for c in columns]
        parts, held = [[c[cut:] for c in columns]], held - cut
    if parts:
        yield [np.concatenate(c) for c in zip(*parts, strict=True)]


def _bounds(lists: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(lists[1:] != lists[:-1]) + 1, [len(lists)]])


def leaders(reps: np.ndarray, sizes: np.ndarray, sigs: np.ndarray, matches: int, percent: int) -> list[tuple[int, np.ndarray]]:
    """Up to LEADERS members, by place, each the nearest to the consensus of those left, and the places that follow each."""
    rest, found = np.arange(len(reps)), []
    offsets = 256 * np.arange(COORDINATES)
    for _ in range(LEADERS):
        if len(rest) < 2:
            break
        part = sigs[rest]
        consensus = np.bincount((part + offsets).ravel(), minlength=256 * COORDINATES).reshape(COORDINATES, 256).argmax(axis=1).astype(np.uint8)
        best = int(np.lexsort((reps[rest], -equal_counts(part, consensus)))[0])
        taken = (equal_counts(part, part[best]) >= matches) & sizes_allow(sizes[rest], sizes[rest[best]], percent)
        taken[best] = False
        if taken.any():
            found.append((int(rest[best]), rest[taken]))
        taken[best] = True
        rest = rest[~taken]
    return found


def _stars(batches: Iterator[pa.RecordBatch], matches: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (list, token, rep, n, sig) in order of list, to (token, leader, follower, followers)."""
    for lists, tokens, reps, sizes, sigs in whole_lists(batches):
        cuts = _bounds(lists).tolist()
        out: list[tuple[int, int, np.ndarray]] = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                out += [(int(tokens[a]), int(reps[a + k]), reps[a + taken]) for k, taken in leaders(reps[a:b], sizes[a:b], sigs[a:b], matches, percent)]
        sized = [len(f) for _, _, f in out]
        columns = [np.repeat(np.array([x[k] for x in out], dtype=np.int64), sized) for k in (0, 1)]
        followers = np.concatenate([f for _, _, f in out]) if out else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(followers, pa.int64()), pa.array(np.repeat(np.array(sized, np.int64), sized))], names=STARS.names)


def _small_edges(lists: np.ndarray, comps: np.ndarray, sizes: np.ndarray, sigs: np.ndarray, matches: int, percent: int) -> np.ndarray:
    """Candidate pairs of components from lists of up to SMALL members, all lists at once."""
    found = [np.zeros((0, 2), dtype=np.int64)]
    for shift in range(1, SMALL):
        at = np.flatnonzero(lists[shift:] == lists[:-shift])
        if not len(at):
            break
        at = at[(comps[at] != comps[at + shift]) & sizes_allow(sizes[at], sizes[at + shift], percent)]
        at = at[equal_counts(sigs[at], sigs[at + shift]) >= matches] if len(at) else at
        found.append(np.stack([comps[at], comps[at + shift]], axis=1))
    pairs = np.sort(np.concatenate(found), axis=1)
    return np.unique(pairs, axis=0)


def list_edges(own: np.ndarray, comps: np.ndarray, sizes: np.ndarray, sigs: np.ndarray, matches: int, percent: int) -> np.ndarray:
    """Pairs of components that connect those with candidate pairs; only members with `own` are held against all others."""
    names, of = np.unique(comps, return_inverse=True)
    asked = np.flatnonzero(own)
    cluster = np.arange(len(names))
    edges: list[tuple[int, int]] = []

    def join(x: int, others: np.ndarray) -> None:
        for y in np.unique(of[others]).tolist():
            if cluster[x] != cluster[y]:
                edges.append((int(names[x]), int(names[y])))
                cluster[cluster == cluster[y]] = cluster[x]

    columns = COORDINATES - matches + 1
    pairs16 = np.ascontiguousarray(sigs).view("<u2")
    work = 0
    if columns <= COORDINATES // 2:
        counts = [(np.bincount(pairs16[:, c], minlength=65536), np.bincount(pairs16[asked, c], minlength=65536)) for c in range(columns)]
        work = sum(int(x @ y) for x, y in counts)
    if columns <= COORDINATES // 2 and work < len(asked) * len(comps) // 4:
        for c in range(columns):
            order = np.argsort(pairs16[:, c], kind="stable")
            ordered = pairs16[order, c]
            low, high = np.searchsorted(ordered, pairs16[asked, c], "left"), np.searchsorted(ordered, pairs16[asked, c], "right")
            for start in range(0, len(asked), 256):
                reach = (high - low)[start : start + 256]
                left = np.repeat(asked[start : start + 256], reach)
                right = order[np.repeat(low[start : start + 256] - np.concatenate([[0], np.cumsum(reach)[:-1]]), reach) + np.arange(int(reach.sum()))]
                may = (cluster[of[left]] != cluster[of[right]]) & sizes_allow(sizes[left], sizes[right], percent)
                left, right = left[may], right[may]
                for k in range(0, len(left), 65536):
                    l, r = left[k : k + 65536], right[k : k + 65536]
                    hit = equal_counts(sigs[l], sigs[r]) >= matches
                    for x, y in zip(l[hit].tolist(), r[hit].tolist(), strict=True):
                        join(int(of[x]), np.array([y]))
    else:
        for x in asked.tolist():
            others = np.flatnonzero((cluster[of] != cluster[of[x]]) & sizes_allow(sizes, sizes[x], percent))
            if len(others):
                join(int(of[x]), others[equal_counts(sigs[others], sigs[x]) >= matches])
    return np.array(edges, dtype=np.int64).reshape(-1, 2)


def _merge(batches: Iterator[pa.RecordBatch], matches: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (list, kind, comp, n, sig) in order of list, to pairs of components.

    Of a list with rows of kind 1, those are held against the rows of kind 0; else all against all.
    """
    for lists, kinds, comps, sizes, sigs in whole_lists(batches):
        cuts = _bounds(lists)
        counts = np.diff(cuts)
        small = np.repeat(counts <= SMALL, counts) & (np.repeat(np.add.reduceat(kinds, cuts[:-1]), counts) == 0)
        found = [_small_edges(lists[small], comps[small], sizes[small], sigs[small], matches, percent)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if small[a] or not (comps[a:b] != comps[a]).any():
                continue
            own = kinds[a:b] == 1
            if not own.any():
                names, n = np.unique(comps[a:b], return_counts=True)
                own = comps[a:b] != names[np.argmax(n)]
            found.append(list_edges(own, comps[a:b], sizes[a:b], sigs[a:b], matches, percent))
        pairs = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=EDGES.names)


def block_links(texts: list[bytes], left: np.ndarray, comps: np.ndarray, sigs: np.ndarray, words: int, percent: int, matches: int) -> list[tuple[int, int]]:
    """Links by place that connect the components of a block: members with `left` against the others."""
    values, bounds = shingle_sets(texts, words)
    sizes = np.diff(bounds)
    asked, others = np.flatnonzero(left), np.flatnonzero(~left)
    if not len(asked) or not len(others):
        return []
    owners = np.repeat(np.arange(len(texts)), sizes)
    right = ~left[owners]
    order = np.argsort(values[right], kind="stable")
    held, owner = values[right][order], owners[right][order]
    _, of = np.unique(comps, return_inverse=True)
    group = np.arange(int(of.max()) + 1)
    links = []
    for x in asked.tolist():
        near = others[(group[of[others]] != group[of[x]]) & sizes_allow(sizes[others], sizes[x], percent)]
        near = near[equal_counts(sigs[near], sigs[x]) >= matches] if len(near) else near
        if not len(near):
            continue
        own = values[bounds[x] : bounds[x + 1]]
        low, high = np.searchsorted(held, own, "left"), np.searchsorted(held, own, "right")
        reach = high - low
        places = np.repeat(low - np.concatenate([[0], np.cumsum(reach)[:-1]]), reach) + np.arange(int(reach.sum()))
        both = np.bincount(owner[places], minlength=len(texts))[near]
        for y in near[100 * both >= percent * (sizes[x] + sizes[near] - both)].tolist():
            if group[of[x]] != group[of[y]]:
                links.append((x, y))
                group[group == group[of[y]]] = group[of[x]]
    return links


def _verdicts(batches: Iterator[pa.RecordBatch], words: int, percent: int, matches: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, side, rep, comp, sig, text) in order of block, to links."""

    def judged(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        sides, reps, comps, sigs, texts = zip(*rows, strict=True)
        made = np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, COORDINATES)
        for x, y in block_links([(t or "").encode() for t in texts], np.array(sides) == 0, np.array(comps), made, words, percent, matches):
            yield reps[x], reps[y]

    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=EDGES.names)

    block, rows, found = None, [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != block and rows:
                found += judged(rows)
                rows = []
            block = row[0]
            rows.append(row[1:])
        if len(found) > 20_000:
            yield batch_of(found)
            found = []
    if rows:
        found += judged(rows)
    yield batch_of(found)


class _Texts:
    """The documents, and the blocks of their rows."""

    def __init__(self, spark: SparkSession, docs: DataFrame, blocks: DataFrame) -> None:
        self.spark, self.docs, self.blocks = spark, docs, blocks

    def of(self, wanted: DataFrame) -> DataFrame:
        """(at_block, at_row, text) of the addresses (at_block, at_row) in wanted."""
        folder, label = shared_folder(self.spark, "near-wanted"), "rows-"
        asked = wanted.select(F.col("at_block").alias("block"), "at_row").distinct().mapInArrow(_payloads, "block long, payload binary")
        asked = asked.unionByName(self.blocks.select("block", F.lit(b"").alias("payload"))).repartition("block").sortWithinPartitions("block")
        asked.mapInArrow(lambda batches: keep_by_block(batches, folder, label, np.dtype("<i4"), None), "block long, n long").agg(F.sum("n")).collect()
        return addressed(self.docs, "text").mapInArrow(lambda batches: _picked(batches, folder, label), "at_block long, at_row int, text string")


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, place), to places by block as far as they stand together."""
    for batch in batches:
        blocks, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype("<i4")
        order = np.argsort(blocks, kind="stable")
        cuts = _bounds(blocks[order]) if len(blocks) else np.zeros(1, np.int64)
        parts = [rows[order[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(blocks[order[cuts[:-1]]], pa.int64()), pa.array(parts, pa.binary())], names=["block", "payload"])


def _picked(batches: Iterator[pa.RecordBatch], folder: str, label: str) -> Iterator[pa.RecordBatch]:
    kept = Kept(folder, label, np.dtype("<i4"))
    for batch in batches:
        blocks, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = _bounds(blocks) if len(blocks) else np.zeros(1, np.int64)
        take = [a + np.flatnonzero(np.isin(rows[a:b], kept.of(int(blocks[a])))) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        chosen = batch.take(pa.array(np.concatenate(take) if take else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1), chosen.column(2).cast(pa.string())], names=["at_block", "at_row", "text"])


def _verified(spark: SparkSession, sides: DataFrame, live: DataFrame, texts: _Texts, words: int, percent: int, matches: int) -> DataFrame:
    """Links between the two sides of each block; sides has (block, side, rep, comp)."""
    sides = written(spark, sides.join(exchanged(live.select("rep", "sig", "at_block", "at_row")), "rep"), "near-sides")
    rows = sides.join(exchanged(texts.of(sides)), ["at_block", "at_row"]).select("block", "side", "rep", "comp", "sig", "text").repartition("block").sortWithinPartitions("block")
    links = written(spark, rows.mapInArrow(lambda batches: _verdicts(batches, words, percent, matches), EDGES), "near-links")
    discard(spark, sides)
    return links


def _cut(column: str, pieces: Column) -> Column:
    return F.pmod(F.xxhash64(column), pieces).cast("long")


def _pieces(n: str, size: int) -> Column:
    return F.greatest(F.ceil(F.col(n) / size), F.lit(1)).cast("long")


def _ranked(classes: DataFrame, matches: int) -> DataFrame:
    """(class, tokens): the pairs (df, token) that several classes have, rarest first, of classes with MATCHES of them."""
    posted = classes.select("class", F.posexplode("minima").alias("coordinate", "least"))
    posted = posted.select("class", (F.shiftleft(F.col("coordinate").cast("long"), 32).bitwiseOR(F.col("least").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))).alias("token"))
    counted = posted.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return posted.join(exchanged(counted), "token").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens")).where(F.size("tokens") >= matches)


def _postings(spark: SparkSession, classes: DataFrame, matches: int) -> DataFrame:
    """(rep, n, sig, at_block, at_row, tokens): classes that can have MATCHES equal coordinates with another, and their pairs (df, token), rarest first."""
    ranked = _ranked(classes, matches).join(exchanged(classes.select("class", "rep", "n", "sig", "at_block", "at_row")), "class")
    return written(spark, ranked.select("rep", "n", "sig", "at_block", "at_row", "tokens"), "near-postings")


def _first_links(spark: SparkSession, live: DataFrame, texts: _Texts, words: int, percent: int, matches: int) -> DataFrame:
    """Confirmed links between classes and the leaders of their commonest lists."""
    common = live.select("rep", "n", "sig", F.explode(F.expr(f"slice(tokens, greatest(size(tokens) - {FREQUENT - 1}, 1), {FREQUENT})")).alias("t"))
    common = common.select("rep", "n", "sig", "t.token", F.col("t.df").alias("df"))
    best = None
    while True:  # the leaders of a list's pieces are compared in turn, until no list has several
        listed = common.select(F.xxhash64("token", F.pmod(F.xxhash64("rep"), _pieces("df", CHUNK))).alias("list"), "token", "rep", "n", "sig")
        stars = written(spark, listed.repartition("list").sortWithinPartitions("list", "rep").mapInArrow(lambda batches: _stars(batches, matches, percent), STARS), "near-stars")
        if best is None:
            best = stars.groupBy("b").agg(F.slice(F.sort_array(F.collect_set(F.struct("weight", "a")), False), 1, FOLLOWED).alias("best")).select("b", F.explode("best").alias("x")).select("x.a", "b", "x.weight")
        else:
            best = best.unionByName(stars.select("a", "b", "weight"))
        cut = common.where(F.col("df") > CHUNK)
        if cut.isEmpty():
            break
        led = stars.select("token", F.col("a").alias("rep")).distinct()
        led = written(spark, cut.drop("df").join(exchanged(led), ["token", "rep"]), "near-led")
        common = led.join(led.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "token")
    pairs = written(spark, best.select("a", "b", F.xxhash64("a", _cut("b", _pieces("weight", BLOCK))).alias("block")), "near-pairs")
    sides = pairs.select("block", F.lit(0).alias("side"), F.col("a").alias("rep")).distinct().unionByName(pairs.select("block", F.lit(1).alias("side"), F.col("b").alias("rep")))
    return _verified(spark, sides.withColumn("comp", F.col("rep")), live, texts, words, percent, matches)


def _clusters(spark: SparkSession, placed: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs of components with candidate pairs between them, from the merged lists of the prefixes."""
    prefix = placed.select("rep", "comp", "n", "sig", F.explode("prefix").alias("t")).select("rep", "comp", "n", "sig", "t.token", F.col("t.df").alias("df"))
    pieces = _pieces("df", CHUNK)
    members = prefix.select(F.xxhash64("token", F.pmod(F.xxhash64("rep"), pieces)).alias("list"), F.lit(0).alias("kind"), "comp", "n", "sig")
    long = prefix.where(F.col("df") > CHUNK)
    sizes = long.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("members"))
    mains = sizes.groupBy("token").agg(F.max(F.struct("members", "comp")).alias("top")).select("token", F.col("top.comp").alias("main"))
    outside = long.join(mains, "token").where("comp <> main").select("token", "comp", "n", "sig", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
    outside = outside.select(F.xxhash64("token", "piece").alias("list"), F.lit(1).alias("kind"), "comp", "n", "sig")
    rows = members.unionByName(outside).repartition("list").sortWithinPartitions("list")
    return written(spark, rows.mapInArrow(lambda batches: _merge(batches, matches, percent), EDGES).distinct(), "near-clusters")


def _last_links(spark: SparkSession, placed: DataFrame, edges: DataFrame, texts: _Texts, words: int, percent: int, matches: int) -> DataFrame:
    """Links between the components of each cluster, confirmed on full sets."""
    clusters = components(spark, edges).select(F.col("node").alias("comp"), F.col("label").alias("cluster"))
    inside = written(spark, placed.select("rep", "comp").distinct().join(exchanged(clusters), "comp"), "near-inside")
    sizes = inside.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("members"))
    mains = sizes.groupBy("cluster").agg(F.max(F.struct("members", "comp")).alias("top"), F.sum("members").alias("n_all"))
    mains = mains.select("cluster", F.col("top.comp").alias("main"), "n_all", (F.col("n_all") - F.col("top.members")).alias("n_out"))
    rows = inside.join(exchanged(mains), "cluster")
    spread = lambda pieces: F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("other")
    outs, alls = _pieces("n_out", BLOCK), _pieces("n_all", BLOCK)
    left = rows.where("comp <> main").select("cluster", "rep", "comp", _cut("rep", outs).alias("own"), spread(alls)).select(F.xxhash64("cluster", "own", "other").alias("block"), F.lit(0).alias("side"), "rep", "comp")
    right = rows.select("cluster", "rep", "comp", _cut("rep", alls).alias("own"), spread(outs)).select(F.xxhash64("cluster", "other", "own").alias("block"), F.lit(1).alias("side"), "rep", "comp")
    return _verified(spark, left.unionByName(right), placed, texts, words, percent, matches)


def near_groups(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80, matches: int = MATCHES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    small_batches(spark)
    docs = on_files(spark, docs, "near-docs")
    rows = addressed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = written(spark, rows.mapInArrow(lambda batches: _sign(batches, words), SIGNED), "near-signed")
    blocks = written(spark, signed.select("block").distinct(), "near-blocks")
    known = signed.where("key is not null and doc_id is not null")
    firsts = known.groupBy("key").agg(F.min(F.struct("doc_id", F.col("block").alias("at_block"), F.col("row").alias("at_row"), F.col("n_shingles").alias("n"), "minima", "sig")).alias("first"), F.count(F.lit(1)).alias("copies"))
    full = written(spark, firsts.select("key", F.xxhash64("key").alias("class"), F.col("first.doc_id").alias("rep"), "first.at_block", "first.at_row", "first.n", "first.minima", "first.sig", "copies"), "near-full")
    named = written(spark, signed.select("doc_id", "n_shingles", "key"), "near-named")
    discard(spark, signed)
    live = _postings(spark, full, matches)
    classes = written(spark, full.select("key", "rep", "copies"), "near-classes")
    discard(spark, full)

    texts = _Texts(spark, docs, blocks)
    links = _first_links(spark, live, texts, words, percent, matches)
    labels = components(spark, links)
    prefix = F.expr(f"slice(tokens, 1, size(tokens) - {matches - 1})").alias("prefix")
    placed = live.join(exchanged(labels.select(F.col("node").alias("rep"), F.col("label").alias("comp"))), "rep", "left").select("rep", F.coalesce("comp", "rep").alias("comp"), "n", "sig", "at_block", "at_row", prefix)
    placed = written(spark, placed, "near-placed")
    discard(spark, live)
    edges = _clusters(spark, placed, matches, percent)
    more = _last_links(spark, placed, edges, texts, words, percent, matches)
    discard(spark, placed)

    # a document whose rows have several texts links their classes
    known = named.where("key is not null and doc_id is not null")
    several = known.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("doc_id")
    held = known.join(exchanged(several), "doc_id").select("doc_id", "key").distinct().join(exchanged(classes.select("key", "rep")), "key")
    more = written(spark, more.unionByName(held.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))), "near-links")
    if not more.isEmpty():
        labels = components(spark, links.unionByName(more))

    moved = classes.join(exchanged(labels.withColumnRenamed("node", "rep")), "rep", "left").where("label is not null or copies > 1").select("key", F.coalesce("label", "rep").alias("label"))
    placed_rows = named.join(exchanged(moved), "key", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"))
    return placed_rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
