"""The positive-unlabelled classifier on known mixtures, odd texts and held-out labels."""

import zlib

import numpy as np
import pytest

from waymark.llm import pu_quality, queries


def mixture(rng, n, prior, d=6):
    good = rng.random(n) < prior
    x = rng.normal(size=(n, d)) + np.where(good[:, None], 0.0, np.array([3.0, 2.0, 0, 0, 0, 0])[:d])
    return x, good


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_known_mixture(prior):
    rng = np.random.default_rng(int(prior * 10))
    p, _ = mixture(rng, 4000, 1.0)
    u, _ = mixture(rng, 6000, prior)
    model = pu_quality.fit(p, u)
    assert abs(model.prior - prior) < 0.08
    x, good = mixture(rng, 4000, prior)
    scores = model.score(x)
    assert ((scores >= 0.5) == good).mean() > 0.93
    assert abs(scores.mean() - prior) < 0.08
    order = rng.permutation(len(p))
    assert np.allclose(pu_quality.fit(p[order], u[::-1]).score(x), scores)


def test_risk_is_not_followed_below_zero():
    """With few rows and many features the plain unbiased risk falls below zero; the fitted one must not by much."""
    rng = np.random.default_rng(1)
    p, u = rng.normal(size=(40, 60)), rng.normal(size=(60, 60))
    w = pu_quality.non_negative_fit(p, u, 0.7)
    assert np.logaddexp(0, u @ w).mean() - 0.7 * np.logaddexp(0, p @ w).mean() > -0.05


def test_features_of_odd_texts(odd_texts):
    texts = [t or "" for t in odd_texts]
    found = pu_quality.features(texts)
    assert found.shape == (len(texts), len(pu_quality.FEATURES))
    assert np.isfinite(found).all()
    assert (found[texts.index("")] == 0).all()
    single = np.vstack([pu_quality.features([t]) for t in texts])
    assert np.array_equal(single, found)


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0, 0) for i in range(60)] + [(None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    rows = pu_quality.quality_scores(spark, odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1
        assert row.predicted == (row.score >= 0.3)
    none = pu_quality.quality_scores(spark, odd_docs, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert pu_quality.quality_scores(spark, odd_docs.where("false"), labels).collect() == []


def test_sample_is_bounded(spark, monkeypatch):
    """Many copies of one row are drawn at most once."""
    monkeypatch.setattr(pu_quality, "SAMPLE", 50)
    seen = []
    monkeypatch.setattr(pu_quality, "fit", lambda p, u: seen.append((len(p), len(u))))
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('text ', id) as text").union(spark.range(1500).selectExpr("7L", "'copy'"))
    labels = spark.range(2000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    pu_quality.train(spark, docs, labels)
    assert all(5 < n < 90 for n in seen[0])


def test_held_out_labels(spark):
    data = "/root/testdata/sf0.01"
    scored = queries.op12_pu_quality(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r for r in scored if r.quality == q] for q in (1, 0))
    assert len(good) > 30 and len(bad) > 3
    assert sum(r.predicted == 1 for r in good) >= 0.97 * len(good)
    assert sum(r.predicted == 0 for r in bad) >= 0.8 * len(bad)
