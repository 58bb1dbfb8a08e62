"""The pipeline over a small corpus, stage by stage, against plain versions."""

import random
from collections import Counter

import corpus_pipeline


def corpus():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [prose(rng.randrange(60, 200)) for _ in range(120)]
    texts += [texts[3], texts[3], texts[4] + " tail"]  # copies, a near copy
    passage = prose(60)
    texts += [prose(80) + " " + passage + " " + prose(80) for _ in range(4)]  # a passage that repeats
    item = prose(30)
    texts += [prose(90) + " " + item + " " + prose(90)]  # a leak
    texts += ["too short", "", None, " ".join("#%&" for _ in range(90))]
    return texts, passage, item


def test_stages(spark, tmp_path):
    texts, passage, item = corpus()
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/stage{number}")
        docs = spark.read.parquet(f"{tmp_path}/stage{number}")
        seen.append({r.doc_id: r for r in docs.collect()})
    good, single, cut, clean = seen
    assert set(good) == set(range(128))
    assert set(single) == set(range(128)) - {120, 121, 122}
    assert set(cut) == set(single)
    for i in range(123, 127):
        assert len(cut[i].text) <= len(texts[i]) - len(passage) and cut[i].n_chars == len(cut[i].text)
    assert all(cut[i].text == texts[i] for i in range(120))
    assert set(clean) == set(cut) - {127}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(clean)
    lengths = Counter()
    for r in pieces:
        lengths[r.doc_id] += r.length
    assert all(lengths[r.doc_id] == r.doc_tokens for r in pieces)


def test_five_named_stages():
    assert len(corpus_pipeline.STAGES) == 5 and all(callable(f) for _, f in corpus_pipeline.STAGES)


def test_run_over_odd_documents(spark, tmp_path, odd_texts):
    """Nulls, empty and very long texts, ties, repeated rows and ids, and columns whose names the stages use themselves."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randrange(60, 200))) for _ in range(60)]
    long = " ".join(rng.choice(words) for _ in range(40_000))
    texts = [*odd_texts, *prose, long, prose[0], prose[1] + " more"]
    rows = [(i if i % 17 else None, t, "en" if i % 3 else None, f"s{i % 2}", len(t or ""), "x", 7, i) for i, t in enumerate(texts)]
    rows += [rows[-1], (61, prose[5] + " other text", "en", "s1", 3, "x", 7, 0), (None, None, None, None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, block long, row long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(prose[9].split()[:30])), (None, None), (8, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    lengths, totals = Counter(), {}
    for r in pieces:
        lengths[r.doc_id] += r.length
        totals.setdefault(r.doc_id, set()).add(r.doc_tokens)
    named = {i: t for i, t in enumerate(texts) if i % 17}
    kept = set(lengths)
    copies = [i for i, t in named.items() if t == prose[0]]
    assert len(kept & set(copies)) == min(1, len(copies))
    assert all(i in kept for i, t in named.items() if t in prose[12:] and texts.index(t) == i)
    assert texts.index(prose[9]) not in kept or texts.index(prose[9]) % 17 == 0
    assert all(lengths[i] == sum(totals[i]) for i in kept if i is not None and len(totals[i]) == 1 and i not in (61, len(texts) - 1))


def test_run_over_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
