"""Counts by brute force; estimates against the same steps in numpy."""

import itertools
import random
import re
from collections import Counter

import numpy as np

from waymark.llm import mcd

SYMBOLS = set("#*$%&|<>")


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), len(lines)


def corpus():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(900)]
    rows = []
    for i in range(1400):
        body = [rng.choice(words) for _ in range(int(rng.lognormvariate(5, 0.7)) + 3)]
        if i % 20 == 3:
            body = [w + "%%%" for w in body]
        if i % 35 == 5:
            body = body[:20] * 6
        text = " ".join(body) if i % 3 else "\n".join(" ".join(body[k : k + 9]) for k in range(0, len(body), 9))
        if i % 50 == 7:
            text = "\n".join([text.split("\n")[0]] * 12) + "\n" + text
        rows.append((i, text, ["en", "de", None][i % 7 % 3], "hot" if i % 2 else f"src{i % 5}"))
    return rows


FLOOR = np.diag((np.array(mcd.FLOORS) * mcd.SCALE) ** 2)


def starts(z):
    """The three starts: (mean, covariance)."""
    bins = np.floor(z / mcd.VALUES)
    quantile = lambda x, p: np.sort(x)[int(np.ceil(p * len(x))) - 1] * mcd.VALUES + mcd.VALUES // 2
    median = np.array([quantile(c, 0.5) for c in bins.T], float)
    sd = np.array([(quantile(c, 0.75) - quantile(c, 0.25)) / 1.349 for c in bins.T])
    wide = np.sqrt(sd**2 + np.diag(FLOOR))
    u = (z - median) / wide
    signs = np.round(mcd.SCALE * u / np.maximum(np.sqrt((u**2).sum(1, keepdims=True)), 1e-9))
    return [(median, np.diag(sd**2)), (z.mean(0), np.cov(z.T, bias=True)), (median, np.cov(signs.T, bias=True) * mcd.D / mcd.SCALE**2 * np.outer(wide, wide))]


def estimate(z):
    """The best mean and covariance by the operator's steps, and the logarithm of its determinant."""
    z = np.asarray(z, float)
    found = []
    for mean, cov in starts(z):
        for _ in range(mcd.STEPS):
            off = z - mean
            d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov + FLOOR), off)
            bins = np.floor(np.log2(np.maximum(d, 1e-9)) * mcd.BINS)
            part = z[bins <= np.sort(bins)[int(np.ceil(mcd.SHARE * len(z))) - 1]]
            mean, cov = part.mean(0), np.cov(part.T, bias=True)
            found.append((np.linalg.slogdet(cov + FLOOR)[1], mean, cov))
    return min(found, key=lambda x: x[0])


def test_counts_and_verdicts(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, kept int").repartition(5)
    verdicts = mcd.quality_verdicts(spark, df)
    plan = verdicts._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    got = {r.doc_id: r for r in verdicts.collect()}
    vectors, groups = {}, {}
    for i, text, lang, source in rows:
        n, chars, symbols, dup, repeat, lines = counts(text)
        failed = n < 50 or 100 * repeat > 50 * n
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, chars, symbols, dup, repeat, failed)
        if not failed:
            vectors[i] = [round(mcd.SCALE * x) for x in (np.log1p(n), np.log(chars / n), np.log1p(100 * symbols / chars), np.log1p(10 * dup / lines), np.log1p(10 * repeat / n))]
            for key in ((lang, source), (lang,), ()):
                groups.setdefault(key, []).append(i)
    def drawn(key):
        own = groups[key]
        _, mean, cov = estimate([vectors[i] for i in own])
        cov = cov * mcd.consistency(mcd.SHARE, mcd.D)
        if not key:
            return mean, cov
        above = drawn(key[:-1])
        pull = lambda a, b: (len(own) * a + mcd.PRIOR * b) / (len(own) + mcd.PRIOR)
        return pull(mean, above[0]), pull(cov, above[1])

    known = {key: drawn(key) for key in groups if len(key) == 2}
    for i, _, lang, source in rows:
        if i not in vectors:
            assert not got[i].kept
            continue
        mean, cov = known[lang, source]
        off = np.array(vectors[i]) - mean
        distance = off @ np.linalg.inv(cov + FLOOR) @ off
        assert abs(got[i].distance - distance) < 1e-3 * (1 + distance)
        assert got[i].kept == (got[i].distance <= mcd.LIMIT)
    marked = [got[i] for i in vectors if i % 20 == 3]
    assert len(marked) > 30 and not any(r.kept for r in marked)
    assert all(got[i].kept for i in vectors if i % 20 != 3 and i % 35 != 5 and i % 50 != 7)
    kept = mcd.keep_good(spark, df.repartition(2)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, r in got.items() if r.kept) and kept[0].asDict().keys() == set(df.columns)
    assert {(r.doc_id, r.text) for r in kept} <= {(i, text) for i, text, _, _ in rows}


def test_odd_texts(spark, odd_docs):
    got = mcd.quality_verdicts(spark, odd_docs).collect()
    want = Counter((r.doc_id, *counts(r.text)[:5]) for r in odd_docs.collect())
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(r.kept is not None and r.base_failed is not None for r in got)


def test_quantiles():
    assert abs(mcd.chi_squared_quantile(0.95, 1) - 3.841458820694124) < 1e-9
    assert abs(mcd.chi_squared_quantile(0.99, 5) - 15.08627246938899) < 1e-9
    assert mcd.consistency(0.999999, 5) < 1.001


def test_small_groups_against_an_exact_search(spark):
    """Over all subsets of three quarters, none has a determinant much smaller than the one that is found."""
    rng = np.random.default_rng(5)
    rows = []
    for group in range(6):
        z = rng.normal(size=(13, 5)) @ rng.normal(size=(5, 5)) * 9000 + 50_000
        z[:3] += rng.normal(size=5) * 90_000
        rows += [(f"g{group}", [int(x) for x in v]) for v in z]
    vectors = spark.createDataFrame([([g], *v) for g, v in rows], "groups array<string>, z0 long, z1 long, z2 long, z3 long, z4 long").repartition(3)
    counted = vectors.select("groups", *(f"z{k}" for k in range(5)))
    got = {r.grp: r.logdet for r in mcd.concentrated(spark, counted).collect()}
    for group in range(6):
        z = np.array([v for g, v in rows if g == f"g{group}"], float)
        need = int(np.ceil(mcd.SHARE * len(z)))
        best = min(np.linalg.slogdet(np.cov(z[list(part)].T, bias=True) + FLOOR)[1] for part in itertools.combinations(range(len(z)), need))
        assert best - 1e-6 <= got[f"g{group}"] + 1.0 and got[f"g{group}"] < best + 1.0


def test_many_groups_are_joined_in_pieces(spark):
    rows = spark.createDataFrame([("a", i, 0, 0, 0, 0) for i in range(50)], "grp string, z0 long, z1 long, z2 long, z3 long, z4 long")
    known = spark.createDataFrame([("a", 7), ("b", 8)], "grp string, what int")
    assert sorted(map(tuple, mcd._attached(rows, known, False).collect())) == sorted(map(tuple, mcd._attached(rows, known, True).collect()))
