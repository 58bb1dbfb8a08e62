"""Near-duplicate groups against brute force."""

import random

import numpy as np
import pytest

from waymark.llm import minhash_join
from waymark.llm.components import components
from waymark.llm.shingles import jaccard_at_least, shingle_sets


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute(rows, n, percent=80):
    sets = {i: shingles(t, n) for i, t in rows}
    ids = sorted(sets)
    label = {i: i for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6))) for _ in range(500)]
    texts = [None, "", " \t\n", "One", "one", "ONE\n", "one two", "a b c d e", "a b c d", "a b c d f", "É é", "é É", "x" * 3000, "w " * 500]
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 30, 120, 400]))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 4)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "  "]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    base = [rng.choice(vocabulary) for _ in range(150)]  # one large group about a base that is not its smallest id
    for _ in range(120):
        copy = list(base)
        for _ in range(rng.randrange(2, 14)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts.append(" ".join(base))
    return [(i * 7 % 1000 - 3, t) for i, t in enumerate(texts)]


def test_shingle_sets_match_words():
    texts = [(t or "").encode() for _, t in corpus()]
    for n in (1, 2, 5):
        values, bounds = shingle_sets(texts, n)
        assert np.diff(bounds).tolist() == [len(shingles(t.decode(), n)) for t in texts]
        sets = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i in range(0, len(texts), 7):
            for j in range(0, len(texts), 3):
                a, b = shingles(texts[i].decode(), n), shingles(texts[j].decode(), n)
                assert jaccard_at_least(sets[i], sets[j], 80) == bool(a and b and 100 * len(a & b) >= 80 * len(a | b))
    assert [x.tolist() for x in shingle_sets([], 2)] == [[], [0]]


@pytest.mark.parametrize("words", [2, 5])
def test_groups(spark, words):
    rows = corpus()
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, component_id long, key string").repartition(5)
    want = brute(rows, words)
    got = minhash_join.near_groups(spark, df, words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chunked_lists(spark, monkeypatch):
    monkeypatch.setattr(minhash_join, "CHUNK", 16)
    monkeypatch.setattr(minhash_join, "BLOCK", 8)
    monkeypatch.setattr(minhash_join, "FREQUENT", 1)
    rows = corpus(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = minhash_join.near_groups(spark, df, 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2)


def test_odd_rows(spark, odd_docs):
    got = minhash_join.near_groups(spark, odd_docs, 2).collect()
    assert len(got) == odd_docs.count()
    assert [r for r in got if r.doc_id is None][0].kept and all(r.kept is not None for r in got)
    assert minhash_join.near_groups(spark, odd_docs.limit(0), 2).count() == 0


def test_a_document_with_two_texts_links_both(spark):
    words = [f"w{i}" for i in range(80)]
    one, two = " ".join(words[:40]), " ".join(words[40:])
    df = spark.createDataFrame([(5, one), (5, two), (7, one + " tail"), (6, two + " tail"), (8, "apart")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash_join.near_groups(spark, df, 2).collect()} == {(5, 5), (6, 5), (7, 5), (8, 8)}


@pytest.mark.parametrize("spread", [2, 256])
def test_edges_of_long_lists(spread):
    """Both ways through a list connect what all pairs connect; few byte values make the pairs of bytes too common to help."""
    rng = np.random.default_rng(spread)
    sigs = rng.integers(0, spread, (400, 64), dtype=np.uint8)
    for k in range(1, 400, 3):
        sigs[k] = np.where(rng.random(64) < 0.75, sigs[k - 1], sigs[k])
    comps, sizes = rng.integers(0, 350, 400), rng.integers(80, 120, 400)

    def labels(pairs):
        name = list(range(350))
        for a, b in pairs:
            a, b = name[a], name[b]
            name = [min(a, b) if x in (a, b) else x for x in name]
        return name

    for own in (np.ones(400, bool), np.arange(400) % 4 == 0):
        pairs = [(comps[i], comps[j]) for i in range(400) for j in range(400) if (own[i] or own[j]) and (sigs[i] == sigs[j]).sum() >= 34 and 100 * min(sizes[i], sizes[j]) >= 80 * max(sizes[i], sizes[j])]
        got = minhash_join.list_edges(own, comps, sizes, sigs, 34, 80).tolist()
        assert len(got) < 350 and labels(got) == labels(pairs)


def test_components_of_a_chain(spark):
    n = 70
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 400), (400, 500), (9, 9)], "a long, b long")
    labels = {r.node: r.label for r in components(spark, links).collect()}
    assert labels == {**{i: 0 for i in range(n + 1)}, 400: 400, 500: 400}


def test_postings_and_components_are_not_broadcast(spark, odd_docs):
    """Small as the tables are, Spark's limit for broadcasts must not decide: it underestimates what arrays explode to."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    minhash_join.near_groups(spark, odd_docs, 2, 80).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = store.executionsList()
    plans = [found.apply(k).physicalPlanDescription() for k in range(int(before), found.size())]
    joined = [p for p in plans if "Join" in p and ("posexplode" in p or "cc-labels" in p)]
    assert any("posexplode" in p for p in joined) and any("cc-labels" in p for p in joined)
    assert not [p for p in joined if "BroadcastExchange" in p and "posexplode" in p]
    assert not [p for p in joined if "BroadcastExchange" in p and "cc-labels" in p and "cc-edges" in p]


def test_rows_are_not_joined_with_a_broadcast(spark, odd_docs):
    """The last join, of all rows with the classes that have copies or links, is by exchange too; both grow with the input."""
    rows = minhash_join.near_groups(spark, odd_docs, 2, 80)
    assert rows.where("component_id <> doc_id").count() > 0
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan.split("Initial Plan")[0]
