"""Repeated substrings against brute force; the loser tree; anchors."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from waymark.llm import anchors as an
from waymark.llm import suffix_dedup as s
from waymark.llm.common import local_path


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        flags = gone[:-1]
        out.append((len(t), int(flags.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(bytes(x for x, g in zip(t, flags) if not g)).hexdigest()))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(rng.randrange(length // 8, length)) for _ in range(12)]
    texts = [None, "", "short", "ab" * length, "x" * (length - 1), "x" * length, "y" * (length + 1), "z" * 3 * length]
    for _ in range(50):
        parts = [prose(rng.randrange(0, length))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 2)
            parts += [p[a : a + rng.randrange(length // 2, 3 * length)], prose(rng.randrange(0, length // 2))]
        texts.append("".join(parts))
    base = prose(3 * length)
    for _ in range(12):  # near copies
        copy = list(base)
        for _ in range(rng.randrange(1, 12)):
            copy[rng.randrange(len(copy))] = rng.choice("qrst")
        texts.append("".join(copy))
    return texts + [texts[-1], texts[20], texts[20]]


@pytest.mark.parametrize(("length", "seed"), [(200, 1), (40, 2), (12, 3)])
def test_against_brute_force(spark, length, seed):
    texts = corpus(seed, length)
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, block string, row int").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in s.repeat_digests(spark, df, length).collect()}
    want = brute([(t or "").encode() for t in texts], length)
    assert got == dict(enumerate(want)) and sum(w[1] > 0 for w in want) > 10


@pytest.mark.parametrize(("length", "hot"), [(200, 1), (200, 40), (40, 1), (12, 1)])
def test_split_grams(spark, length, hot):
    """A sentence shorter than a string that a third of all texts hold between different neighbours, and all grams split."""
    rng = random.Random(length + hot)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    gram = s.gram_of(length)
    sentence = prose(gram + length // 8)
    texts = [prose(rng.randrange(length)) + (sentence if i % 3 == 0 else "") + prose(rng.randrange(length)) for i in range(150)]
    texts += [t[: len(t) // 2] + prose(9) + t[len(t) // 3 :] for t in texts[:30]] + corpus(length, length)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in s.repeat_digests(spark, df, length, hot).collect()}
    assert got == dict(enumerate(brute([(t or "").encode() for t in texts], length)))


def test_equal_strings_meet_in_a_class():
    rng = random.Random(9)
    length, gram = 200, s.gram_of(200)
    core = bytes(rng.choice(b"abc") for _ in range(gram))
    for _ in range(300):
        left = rng.randrange(length - gram + 1)
        string = bytes(rng.choice(b"abc") for _ in range(left)) + core + bytes(rng.choice(b"abc") for _ in range(length - gram - left))
        heads = []
        for _ in range(2):
            before, behind = (bytes(rng.choice(b"xyz") for _ in range(rng.randrange(60))) for _ in range(2))
            text, at = before + string + behind, len(before) + left
            first, last = rng.randrange(max(0, at - length + gram), len(before) + 1), rng.randrange(len(before), min(at, len(text) - length) + 1)
            heads.append(set(s.class_heads(b"h" * 8, text, at, first, last, gram, length)))
            assert 1 <= len(heads[-1]) <= s.CLASSES
        assert heads[0] & heads[1]


def test_small_runs_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(s, "RUN_BYTES", 2000)
    texts = corpus(5, 40)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in s.repeat_digests(spark, df, 40).collect()}
    assert got == dict(enumerate(brute([(t or "").encode() for t in texts], 40)))


def test_texts_that_remain(spark):
    texts = corpus(6, 200)
    df = spark.createDataFrame([(i, t, i * 2) for i, t in enumerate(texts)], "doc_id long, text string, n_removed long").drop("n_removed")
    rows = s.remove_repeats(spark, df).collect()
    want = brute([(t or "").encode() for t in texts], 200)
    for r in rows:
        assert r.n_removed == want[r.doc_id][1]
        if not r.n_removed:
            assert r.text == texts[r.doc_id]
    assert s.remove_repeats(spark, df.limit(0)).count() == 0 and s.repeat_digests(spark, df.limit(0)).count() == 0


def test_odd_rows(spark, odd_docs):
    assert s.repeat_digests(spark, odd_docs).count() == odd_docs.count()


def test_loser_tree_merges_and_spares_comparisons():
    rng = random.Random(4)
    runs = [sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))).encode() for _ in range(60)}) for _ in range(11)]

    def coded(run):
        last = b""
        for text in run:
            yield text, s.common_prefix(last, text, 0)
            last = text

    tree = s.LoserTree([coded(run) for run in runs])
    out = [(text, shared) for text, shared, _ in tree]
    assert [text for text, _ in out] == sorted(x for run in runs for x in run)
    for (a, _), (b, shared) in zip(out, out[1:]):
        assert shared == s.common_prefix(a, b, 0)
    assert tree.compared < 2 * len(out)
    assert list(s.LoserTree([])) == [] if s.LoserTree else True


def test_front_coding_round_trip():
    places = np.array([(1, 2, 3), (4, 5, 6)], dtype=s.PLACE)
    entries = [(b"headheadaaa", 1, places[:1]), (b"headheadaab", 2, places), (b"zz", 0, places[1:])]
    got = list(s.read_run(s.front_code(entries)))
    assert [(t, a, p.tolist()) for t, _, a, p in got] == [(t, a, p.tolist()) for t, a, p in entries]


def test_anchors_against_plain_search():
    rng = np.random.default_rng(2)
    for n, length, gram in ((10, 5, 2), (500, 40, 24), (3000, 200, 104), (200, 200, 104), (150, 200, 104)):
        raw = rng.integers(97, 100, n, dtype=np.uint8)
        where, grams, first, last = an.anchors(raw, length, gram)
        hashes = an.gram_hashes(raw, gram) & ~np.uint64((1 << an.PLACE_BITS) - 1)
        want = [p + int(np.argmin(hashes[p : p + length - gram + 1])) for p in range(n - length + 1)]
        assert [w for w, a, b in zip(where.tolist(), first.tolist(), last.tolist()) for _ in range(a, b + 1)] == want
    long = rng.integers(97, 123, 200_000, dtype=np.uint8)
    hashes = an.gram_hashes(long, 30)
    assert hashes[70_000] == an.gram_hashes(long[70_000:70_030], 30)[0]


def test_a_lost_file_is_an_error(spark, tmp_path, monkeypatch):
    texts = corpus(7, 40)
    df = s.on_files(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), "docs")
    folder = s.find_repeats(spark, df, 40)
    monkeypatch.setattr(s, "find_repeats", lambda *_: folder)
    want = dict(enumerate(brute([(x or "").encode() for x in texts], 40)))
    assert {r.doc_id: tuple(r)[1:] for r in s.repeat_digests(spark, df, 40).collect()} == want
    home = local_path(folder)
    spans = [name for name in os.listdir(home) if name.startswith("span-")]
    assert len(spans) == df.select(s.F.input_file_name()).distinct().count()
    os.remove(f"{home}/{spans[0]}")
    with pytest.raises(Exception, match="No such file"):
        s.repeat_digests(spark, df, 40).collect()


def test_buckets_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(s, "BUCKET_BYTES", 3000)
    texts = corpus(8, 40)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in s.repeat_digests(spark, df, 40).collect()}
    assert got == dict(enumerate(brute([(x or "").encode() for x in texts], 40)))
