"""Encoding, token counts, shards and packing against the library itself."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from waymark.llm import packing, sstable, token_counts
from waymark.llm.bpe import ByteBpe
from waymark.llm.common import SharedFiles, shared_folder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(BYTES)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_cached_encoder_is_the_library(odd_texts, plain):
    encoder = ByteBpe(BYTES)
    for _ in range(2):
        for text, raw in zip(odd_texts, encoder.encode_many(odd_texts)):
            assert np.frombuffer(raw, dtype="<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


def test_token_counts(spark, odd_docs):
    whole = Tokenizer.from_file(WORDS)
    rows = token_counts.count_tokens(spark, odd_docs, WORDS).collect()
    texts = odd_docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), n := len(whole.encode(r.text or "", add_special_tokens=False).ids), n > 2048) for r in texts)
    assert Counter(map(tuple, rows)) == want
    assert any(r.over_limit for r in rows)


def test_token_counts_of_nothing(spark, odd_docs):
    assert token_counts.count_tokens(spark, odd_docs.limit(0), WORDS).count() == 0


def test_shards_round_trip(spark, odd_docs, plain):
    rows = sstable.token_shards(spark, odd_docs, BYTES, end_id=0).collect()
    docs = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start, want = 0, []
    for r in docs:
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert Counter(map(tuple, rows)) == Counter(want)
    assert sstable.token_shards(spark, odd_docs.limit(0), BYTES).count() == 0


def test_shard_lookup(spark, odd_docs, plain):
    folder = shared_folder(spark, "lookup")
    shards = sstable.write_shards(spark, odd_docs, folder, BYTES, 0)
    texts = defaultdict(list)
    for r in odd_docs.collect():
        texts[r.doc_id].append(plain.encode(r.text or "", add_special_tokens=False).ids + [0])
    found = defaultdict(list)
    for name, _, _ in shards:
        with SharedFiles(folder).open(name) as file:
            reader = sstable.ShardReader(file)
            for doc_id in [*texts, -1, 10**12]:
                found[doc_id] += [x.tolist() for x in reader.get(doc_id)]
    assert {k: v for k, v in found.items() if v} == dict(texts)


def test_shard_blocks_and_damage(tmp_path):
    keys = [sstable.key_of(i) for i in range(-500, 3000)]
    writer = sstable.ShardWriter(4)
    raw = bytearray(b"".join(writer.parts((k, np.arange(i % 400, dtype="<u4").tobytes()) for i, k in enumerate(keys))))
    path = tmp_path / "x.sst"
    path.write_bytes(raw)
    with open(path, "rb") as file:
        reader = sstable.ShardReader(file)
        assert len(reader.places) > 3 and [k for k, _ in reader] == keys
        assert reader.get(77)[0].tolist() == list(range(577 % 400)) and reader.get(5000) == []
        assert sum(bool(reader.get(i)) for i in range(10_000, 10_400)) == 0
    raw[100] ^= 1
    path.write_bytes(raw)
    with open(path, "rb") as file, pytest.raises(ValueError):
        list(sstable.ShardReader(file))


def check_pack(lengths, capacity):
    pieces, limits = packing.pack(lengths, capacity)
    assert limits.sum() == sum(lengths) and all(x == capacity or x & (x - 1) == 0 for x in limits.tolist())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for document, start, length, sequence, offset in pieces:
        by_doc[document].append((start, length))
        by_sequence[sequence].append((offset, length))
    for document, n in enumerate(lengths):
        at = 0
        for start, length in sorted(by_doc[document]):
            assert start == at and length > 0
            at += length
        assert at == n
    for sequence, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == limits[sequence]
    return pieces, limits


def test_pack_fills_everything_and_balances():
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.lognormal(6, 1.2, 3000)] + [2048, 4096, 1, 1, 100_000]
    pieces, limits = check_pack(lengths, 2048)
    assert len(pieces) < len(lengths) + 2 * len(limits)
    costs = np.zeros(len(limits))
    whole = np.zeros(len(limits), dtype=bool)
    for _, _, length, sequence, _ in pieces:
        costs[sequence] += length + length * length / 1024
        whole[sequence] |= length == 2048
    shared = costs[(limits == 2048) & ~whole]
    assert shared.std() < 0.35 * shared.mean()
    check_pack([1], 2048)
    check_pack([], 2048)


def test_packing_rows(spark, odd_docs, plain):
    rows = packing.pack_documents(spark, odd_docs, BYTES).collect()
    want, got = Counter(), Counter()
    for r in odd_docs.collect():
        want[r.doc_id] += len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1
    ids = {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [1] for r in odd_docs.collect()}
    for r in rows:
        got[r.doc_id] += r.length
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
    assert got == want
    assert packing.pack_documents(spark, odd_docs.limit(0), BYTES).count() == 0
