"""Mined phrases against all phrases counted one by one."""

import random
import re
from collections import Counter

import pytest

from waymark.llm import collocations


def plain(docs, least, percent, most):
    """docs: (lang, text)."""
    counts, out = {}, set()
    for lang, text in docs:
        mine = counts.setdefault("und" if lang is None else lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            mine.update(words[i : i + k] for k in range(1, 5) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        n = sum(c for words, c in f.items() if len(words) == 1)
        candidates = {words: a for words, a in f.items() if len(words) > 1 and a >= least}
        rows = []
        for words, a in candidates.items():
            score, _, l, r = min((2000000 * a // (f[words[:k]] + f[words[k:]]), k, f[words[:k]], f[words[k:]]) for k in range(1, len(words)))
            inside = lambda other: any(other[i : i + len(words)] == words for i in range(len(other) - len(words) + 1))
            if not any(len(other) > len(words) and 100 * b >= percent * a and inside(other) for other, b in candidates.items()):
                rows.append((-score, -a, " ".join(words).encode(), l, r))
        out |= {(lang, rank, p.decode(), -a, l, r, n, -s) for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:most], 1)}
    return out


def run(spark, rows, **how):
    found = collocations.mine(spark, rows, **how)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    listed = list(map(tuple, found.collect()))
    assert len(listed) == len(set(listed))
    return set(listed)


def corpus(seed, texts=150):
    rng = random.Random(seed)
    words = "of the and Of THE éa Éa straße x' 日本 a b c d #tag e-f".split()
    fixed = ["a b c d", "of the and", "x' 日本 straße", "b b b", "the the"]
    marks = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\x0b", "!", "?x", " ; ", ":", "\x85", "\x1c"]
    out = [(None, None), ("en", ""), ("en", " \t.!\n"), ("", "a b a b a b"), ("und", "of the"), (None, "of the"), ("de", "of " * 400), ("fr", "solo")]
    for _ in range(texts):
        text = "".join(rng.choice(words) + rng.choice(marks) if rng.random() < 0.7 else rng.choice(fixed) + " " for _ in range(rng.randrange(1, 60)))
        out.append((rng.choice(["en", "en", "en", "de", None]), text))
    return out + out[-20:]


@pytest.mark.parametrize("seed,least,most,block", [(1, 5, 2000, 1_000_000), (2, 3, 7, 50), (3, 30, 40, 1)])
def test_against_plain_counts(spark, monkeypatch, seed, least, most, block):
    monkeypatch.setattr(collocations, "GROUP", 2)
    rows = corpus(seed)
    docs = spark.createDataFrame([(None if i % 9 == 0 else i % 30, t, lang, "z", 1, 2) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, block string, l long, word int").repartition(4)
    assert run(spark, docs, least=least, most=most, block_words=block) == plain(rows, least, 80, most)


def test_counts_beyond_64_bits(spark):
    """Scores and comparisons whose products have more than 64 bits."""
    large = 10**15
    names = spark.createDataFrame([(1, 0, 0, large - 1, "en", "a b", 3 * large, 2 * large + 1), (2, 0, 0, large, "en", "b c", large, large)], "id long, l long, r long, f long, lang string, phrase string, head1 long, tail1 long")
    children = spark.createDataFrame([(1, 2, 8 * large // 10 - 1)], "l long, r long, f long")
    found = {tuple(r) for r in collocations._candidates(names, children, 2, 80).collect()}
    a = large - 1
    assert 100 * (8 * large // 10 - 1) < 80 * a or found  # the first is held by exactly its bound or below
    expected = {("en", p, f, l, r, 2000000 * f // (l + r)) for p, f, l, r in (("a b", a, 3 * large, 2 * large + 1), ("b c", large, large, large)) if 100 * (8 * large // 10 - 1) < 80 * f}
    assert found == expected


def test_empty_and_no_phrase(spark):
    assert run(spark, spark.createDataFrame([], "doc_id long, text string, lang string")) == set()
    assert run(spark, spark.createDataFrame([(1, "one two", "en"), (2, None, None)], "doc_id long, text string, lang string")) == set()
