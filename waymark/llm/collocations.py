"""Phrase collocation mining by hierarchical pair naming.

Texts are cut into pieces and words; blocks of texts of one language become sequences of numbers in their task, each
block with its own list of different words and their counts. Then, for phrases of 1, 2, 3 and 4 words in turn:

* each block posts its different words, or pairs of names, with their counts to buckets by hash; a bucket's task sums
  them over all blocks, names what occurs LEAST times or more by an id, and replies to each block that posted;
* a block's replies and its sequence are a file each; the sequence is rewritten in names, with a gap where there is
  none; two names side by side are the next length's pair, since they overlap in all words but the outer two.

A phrase of k frequent words is a pair of frequent phrases of k - 1, so nothing frequent is lost and few others are
counted. The pair is kept as the name's parents: a phrase's cuts are its parents' counts and its grandparents'; and a
phrase is subsumed if one of its children, the phrases longer by a word, is nearly as frequent, because a child is at
least as frequent as any longer phrase that holds it. Names are pairs of ids or whole words, never hashes, and an id is
a bucket's number and a rank in it, so a task that runs again gives the same. A block is called by a hash of its
sequence and place; should a task that runs again see its rows in another order, its blocks get other names and files.

Blocks hold BLOCK_WORDS words or one text, whichever is more; buckets are as many as spark.sql.shuffle.partitions, or
more, so that one holds BUCKET entries or so. Those bound what a task holds. A word that every text has is one entry a
block. What is posted is sorted and packed: a pair takes three to five bytes. The first ranks are chosen in rounds of
bounded groups.

Fixed meanings: null texts count as empty, null languages as `und`. Equal scores go by count, then phrase in order of
UTF-8 bytes; equally low cuts go to the first. Repeated rows and null ids count like any other; ids aren't read. Texts
of any length are read whole. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import SharedFiles, discard, grouped, shared_folder, small_batches, written
from waymark.llm.shingles import mix

LEAST, WORDS, MOST = 30, 4, 2000
#: A phrase is dropped if a longer candidate has at least this percentage of its count.
PERCENT = 80
BLOCK_WORDS, BUCKET = 2_000_000, 4_000_000
#: Times MOST rows that one task ranks.
GROUP = 20

NO_LANGUAGE = "und"
GAP, NOTHING = -1, -2

#: Posts: a block's entries of a bucket, in order of their numbers in the sequence, from n on. Replies, by kind: ids of a
#: post's entries (n as there), a bucket's names, and how often its entries occur in a language.
POSTS = "block long, lang string, bucket int, n long, payload binary"
REPLIES = f"kind string, {POSTS}"
POSTS_ARROW = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64()), ("payload", pa.binary())])
REPLIES_ARROW = pa.schema([("kind", pa.string()), *POSTS_ARROW])
BLOCKS = "block long, lang string"
WORD_NAMES = "lang string, word string, f long, id long"
PAIR_NAMES = "l long, r long, f long, id long"

#: Delimiters of pieces become line feeds, tabs spaces.
_TIDY = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte of their numbers, compressed."""
    together = np.stack([np.asarray(x, dtype="<i8") for x in arrays])
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(np.moveaxis(together[..., None].view(np.uint8), 2, 1)).tobytes())


def _unpack(payload: bytes, arrays: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    return np.ascontiguousarray(np.moveaxis(raw.reshape(arrays, 8, -1), 1, 2)).view("<i8")[..., 0]


def _packed_words(words: list[str], n: list[int]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(("\n".join(words) + "\n" + " ".join(map(str, n))).encode())


def _unpacked_words(payload: bytes) -> tuple[list[str], list[int]]:
    *words, n = zstandard.ZstdDecompressor().decompress(payload).decode().split("\n")
    return words, list(map(int, n.split(" ")))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class _Words(dict):
    """Numbers of words in order of first sight."""

    def __init__(self) -> None:
        super().__init__({b"": NOTHING, b"\n": GAP})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 2
        return number


def _keep(files: SharedFiles, seq: np.ndarray, place: int) -> int:
    """Writes a sequence, with one gap where there are several, and gives its block's name."""
    keep = np.ones(len(seq), dtype=bool)
    keep[1:] = (seq[1:] >= 0) | (seq[:-1] >= 0)
    payload = _pack(seq[keep] + 1)  # gaps as zeros, which pack well
    name = xxhash.xxh3_64_intdigest(payload, seed=place & 0xFFFFFFFFFFFFFFFF) - (1 << 63)
    files.write(f"seq-{name}", iter([payload]))
    return name


def _cut(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of each bucket's entries, which stand together."""
    cuts = np.flatnonzero(np.diff(of, prepend=-1))
    return zip(of[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(of)], strict=True)


class _Block:
    def __init__(self) -> None:
        self.words, self.parts, self.size = _Words(), [], 0

    def add(self, text: str) -> int:
        tokens = text.encode().lower().translate(_TIDY).replace(b"\n", b" \n ").split(b" ")
        numbers = np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens))
        numbers = numbers[numbers != NOTHING]
        self.parts += [numbers, np.array([GAP], np.int32)]
        self.size += (found := int((numbers >= 0).sum()))
        return found

    def posts(self, files: SharedFiles, place: int, lang: str, buckets: int) -> Iterator[pa.RecordBatch]:
        words = list(self.words)[2:]
        if not words:
            return
        seq, prefix = np.concatenate(self.parts), lang.encode() + b"\n"
        counts = np.bincount(seq[seq >= 0], minlength=len(words))
        of = np.array([xxhash.xxh3_64_intdigest(prefix + word) % buckets for word in words])
        order = np.argsort(of, kind="stable")
        number = np.empty(len(words) + 1, dtype=np.int64)
        number[order], number[-1] = np.arange(len(words)), GAP
        block = _keep(files, number[seq], place)
        yield _rows([(block, lang, bucket, a, _packed_words([words[i].decode() for i in order[a:z]], counts[order[a:z]].tolist())) for bucket, a, z in _cut(of[order])], POSTS_ARROW)


def _text_blocks(batches: Iterator[pa.RecordBatch], folder: str, block_words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    files, number = SharedFiles(folder), TaskContext.get().partitionId() << 32
    held: dict[str, _Block] = {}
    total = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal number, total
        for lang, block in held.items():
            yield from block.posts(files, number, lang, buckets)
            number += 1
        held.clear()
        total = 0

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total += held.setdefault(lang, _Block()).add(text)
            if total >= block_words:
                yield from flush()
    yield from flush()


def _file_replies(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Rows (block, lang, n, payload) in order of block, to a file of each block's numbers that have a name, and their ids."""
    files = SharedFiles(folder)
    for block, rows in grouped(batches):
        parts, lang = [], None
        for lang, n, payload in rows:
            places, ids = _unpack(payload, 2)
            parts.append((n + places, ids))
        files.write(f"known-{block}", iter([_pack(*(np.concatenate([part[k] for part in parts]) for k in (0, 1)))]))
        yield pa.RecordBatch.from_pydict({"block": [block], "lang": [lang]})


def _pair_blocks(batches: Iterator[pa.RecordBatch], folder: str, target: str, buckets: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rewrites blocks in names and posts their pairs; after the last pairs no sequence is needed."""
    files, made = SharedFiles(folder), SharedFiles(target)
    for batch in batches:
        for block, lang in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            with files.open(f"seq-{block}") as file:
                seq = _unpack(file.read(), 1)[0] - 1
            with files.open(f"known-{block}") as file:
                places, ids = _unpack(file.read(), 2)
            names = np.full(int(seq.max(initial=0)) + 2, GAP, dtype=np.int64)
            known, names[places] = np.unique(ids, return_inverse=True)  # a gap's -1 is the last of names
            seq = names[seq]
            both = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
            if not len(both):
                continue
            pairs, number, n = np.unique(seq[both] * len(known) + seq[both + 1], return_inverse=True, return_counts=True)
            l, r = known[pairs // len(known)], known[pairs % len(known)]
            of = (mix(mix(l.astype(np.uint64)) + r.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(of, kind="stable")  # within a bucket by l, then r
            if not last:
                place = np.empty(len(pairs), dtype=np.int64)
                place[order] = np.arange(len(pairs))
                found = np.full(len(seq), GAP, dtype=np.int64)
                found[both] = place[number]
                block = _keep(made, found, block)
            yield _rows([(block, lang, bucket, a, _pack(np.diff(l[order[a:z]], prepend=0), r[order[a:z]], n[order[a:z]])) for bucket, a, z in _cut(of[order])], POSTS_ARROW)


def _reply(bucket: int, posts: list[tuple[int, str, int]], sizes: list[int], of: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each post, the places of its entries that have an id; of: the entries' numbers, post after post."""
    at = 0
    for (block, lang, n), size in zip(posts, sizes, strict=True):
        mine = ids[of[at : at + size]]
        places = np.flatnonzero(mine >= 0)
        yield _rows([("reply", block, lang, bucket, n, _pack(places, mine[places]))], REPLIES_ARROW)
        at += size


def _ids(totals: np.ndarray, least: int, bucket: int, buckets: int) -> np.ndarray:
    """Ids of the entries in their order, GAP where there are too few."""
    often = totals >= least
    ids = np.full(len(totals), GAP, dtype=np.int64)
    ids[often] = bucket + buckets * np.arange(int(often.sum()))
    return ids


def _name_words(batches: Iterator[pa.RecordBatch], least: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows are (bucket, block, lang, n, payload) in order of bucket."""
    for bucket, rows in grouped(batches):
        totals: Counter = Counter()
        posts, listed = [], []
        for block, lang, n, payload in rows:
            words, counts = _unpacked_words(payload)
            for word, count in zip(words, counts, strict=True):
                totals[lang, word] += count
            posts.append((block, lang, n))
            listed.append(words)
        order = sorted(totals)
        number = {key: k for k, key in enumerate(order)}
        ids = _ids(np.array([totals[key] for key in order], dtype=np.int64), least, bucket, buckets)
        of = np.array([number[lang, word] for (_, lang, _), words in zip(posts, listed, strict=True) for word in words], dtype=np.int64)
        yield from _reply(bucket, posts, list(map(len, listed)), of, ids)
        by_lang: dict[str, list] = {}
        sums: Counter = Counter()
        for (lang, _), n in totals.items():
            sums[lang] += n
        yield _rows([("total", None, lang, bucket, n, None) for lang, n in sums.items()], REPLIES_ARROW)
        for (lang, word), k in zip(order, ids.tolist(), strict=True):
            if k >= 0:
                by_lang.setdefault(lang, []).append((word, totals[lang, word], k))
        for lang, found in by_lang.items():
            words, f, k = zip(*found, strict=True)
            yield _rows([("names", None, lang, bucket, len(words), _packed_words([*words], [*f, *k]))], REPLIES_ARROW)


def _name_pairs(batches: Iterator[pa.RecordBatch], least: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for bucket, rows in grouped(batches):
        posts, parts = [], []
        for block, lang, n, payload in rows:
            posts.append((block, lang, n))
            l, r, count = _unpack(payload, 3)
            parts.append((np.cumsum(l), r, count))
        l, r, count = (np.concatenate([part[k] for part in parts]) for k in range(3))
        order = np.lexsort((r, l))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (np.diff(l[order]) != 0) | (np.diff(r[order]) != 0)
        of = np.empty(len(order), dtype=np.int64)
        of[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        totals = np.add.reduceat(count[order], np.flatnonzero(fresh))
        ids = _ids(totals, least, bucket, buckets)
        yield from _reply(bucket, posts, [len(part[0]) for part in parts], of, ids)
        yield _rows([("total", None, None, bucket, int(totals.sum()), None)], REPLIES_ARROW)
        often = ids >= 0
        if often.any():
            yield _rows([("names", None, None, bucket, int(often.sum()), _pack(l[first][often], r[first][often], totals[often], ids[often]))], REPLIES_ARROW)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, payload in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            words, numbers = _unpacked_words(payload)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(words), "word": words, "f": numbers[: len(words)], "id": numbers[len(words) :]})


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column(1).to_pylist():
            yield pa.RecordBatch.from_pydict(dict(zip("l r f id".split(), _unpack(payload, 4), strict=True)))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _buckets(spark: SparkSession, entries: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // BUCKET))


def _named(spark: SparkSession, posts: DataFrame, merge: Callable, least: int, buckets: int) -> DataFrame:
    """Replies, names and totals of what is posted, written once, in a folder for each kind."""
    dealt = posts.select("bucket", "block", "lang", "n", "payload").repartition("bucket").sortWithinPartitions("bucket", "block", "n")
    at = shared_folder(spark, "phrase-replies")
    dealt.mapInArrow(lambda batches: merge(batches, least, buckets), REPLIES).write.partitionBy("kind").option("compression", "none").parquet(at)
    made = spark.read.schema(f"{POSTS}, kind string").parquet(at)
    made._waymark_at = at
    return made


def _posted_pairs(spark: SparkSession, named: DataFrame, folder: str, target: str, buckets: int, last: bool) -> DataFrame:
    """The pairs of the blocks in folder, whose replies are filed there first; their next sequences go to target."""
    replies = named.where("kind = 'reply'").select("block", "lang", "n", "payload").repartition("block").sortWithinPartitions("block", "n")
    blocks = written(spark, replies.mapInArrow(lambda batches: _file_replies(batches, folder), BLOCKS), "phrase-blocks")
    tasks = max(1, min(blocks.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return blocks.repartition(tasks).mapInArrow(lambda batches: _pair_blocks(batches, folder, target, buckets, last), POSTS)


def _score(a: str, l: str, r: str) -> str:
    return f"(cast(2000000 as decimal(7,0)) * cast({a} as decimal(20,0))) div (cast({l} as decimal(20,0)) + cast({r} as decimal(20,0)))"


def _cuts(k: int) -> list[tuple[str, str]]:
    """Counts of the two parts, for cuts after 1 to k - 1 words, in the columns of a name of k words."""
    return [(f"head{j}", f"tail{k - j}") for j in range(1, k)]


def _with_parents(names: DataFrame, parents: DataFrame, k: int) -> DataFrame:
    """Names of k words with their phrase, last word, and headJ and tailJ, the counts of their first and last J words."""
    left = parents.select(F.col("id").alias("l"), F.col("lang"), F.col("phrase").alias("start"), *(f"head{j}" for j in range(1, k)))
    right = parents.select(F.col("id").alias("r"), "last", *(f"tail{j}" for j in range(1, k)))
    joined = names.join(left, "l").join(right, "r")
    return joined.select("id", "l", "r", "f", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", *(f"head{j}" for j in range(1, k)), F.col("f").alias(f"head{k}"), *(f"tail{j}" for j in range(1, k)), F.col("f").alias(f"tail{k}"))


def _candidates(names: DataFrame, children: DataFrame | None, k: int, percent: int) -> DataFrame:
    """Names of k words by their lowest cut, without those that a child subsumes."""
    cuts = ", ".join(f"struct({_score('f', l, r)} as score, {j + 1} as cut, {l} as l, {r} as r)" for j, (l, r) in enumerate(_cuts(k)))
    rows = names.select("id", "lang", "phrase", F.col("f").alias("a"), F.array_min(F.expr(f"array({cuts})")).alias("low"))
    if children is not None:
        most = children.select(F.col("l").alias("id"), "f").union(children.select(F.col("r").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("most"))
        held = f"most is not null and cast(100 as decimal(3,0)) * cast(most as decimal(20,0)) >= cast({percent} as decimal(3,0)) * cast(a as decimal(20,0))"
        rows = rows.join(most, "id", "left").where(f"not ({held})")
    return rows.select("lang", "phrase", "a", "low.l", "low.r", "low.score")


_ORDER = (F.desc, F.desc, F.asc)


def _first(spark: SparkSession, rows: DataFrame, most: int) -> DataFrame:
    """The first rows of each language; a task ranks GROUP * most rows or about so many, in rounds."""
    order = [way(name) for way, name in zip(_ORDER, ("score", "a", "phrase"), strict=True)]
    while True:
        largest = rows.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
        pieces = -(-largest // (GROUP * most))
        if pieces < 2:
            return rows.select("*", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long").alias("rank")).where(F.col("rank") <= most)
        piece = F.pmod(F.xxhash64("phrase"), F.lit(pieces))
        place = F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order))
        rows = written(spark, rows.withColumn("piece", piece).withColumn("place", place).where(F.col("place") <= most).drop("piece", "place"), "phrase-ranks")


def mine(spark: SparkSession, docs: DataFrame, least: int = LEAST, percent: int = PERCENT, most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score."""
    small_batches(spark)
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, folder = _buckets(spark, size // 8), shared_folder(spark, "phrase-seqs")  # a word and its space have that many bytes or so; few are different
    posts = texts.mapInArrow(lambda batches: _text_blocks(batches, folder, block_words, buckets), POSTS)
    named = _named(spark, posts, _name_words, least, buckets)
    totals = written(spark, named.where("kind = 'total'").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    entries = totals.agg(F.sum("n")).first()[0] or 0
    words = named.where("kind = 'names'").select("lang", "payload").mapInArrow(_word_rows, WORD_NAMES)
    levels = [written(spark, words.select("id", "lang", "f", F.col("word").alias("phrase"), F.col("word").alias("last"), F.col("f").alias("head1"), F.col("f").alias("tail1")), "phrase-levels")]
    for k in range(2, WORDS + 1):
        before, buckets, target = named, _buckets(spark, entries), shared_folder(spark, "phrase-seqs")
        posts = _posted_pairs(spark, before, folder, target, buckets, k == WORDS)
        named = _named(spark, posts, _name_pairs, least, buckets)
        discard(spark, before)
        _remove(spark, folder)  # sequences and replies that have been rewritten
        folder = target
        entries = named.where("kind = 'total'").agg(F.sum("n")).first()[0] or 0
        pairs = named.where("kind = 'names'").select("lang", "payload").mapInArrow(_pair_rows, PAIR_NAMES)
        levels.append(written(spark, _with_parents(pairs, levels[-1], k), "phrase-levels"))
    rows = None
    for k in range(2, WORDS + 1):
        found = _candidates(levels[k - 1], levels[k] if k < WORDS else None, k, percent)
        rows = found if rows is None else rows.union(found)
    first = _first(spark, written(spark, rows, "phrase-candidates"), most)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
