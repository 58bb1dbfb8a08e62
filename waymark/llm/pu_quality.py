"""Quality classifier by positive-unlabelled learning: non-negative unbiased risk on trusted positives and unlabelled text.

Texts become FEATURES: shares of classes of bytes, of repeated and upper-case words and of repeated lines, and sizes,
all from whole texts, in Arrow batches. Two bounded samples train: positives (label 1, not held out) and unlabelled
texts (any that are not held out), each at most SAMPLE rows, drawn by a hash of id and text at the rate that their
counts give. Negative labels are never used.

* Class prior: a logistic separator of positives from unlabelled texts is fitted on one half of the samples; on the
  other half the prior is the least ratio of unlabelled to positive shares above a score, over all scores, each with an
  allowance for its sampling error (best-bin estimate).
* Risk: prior * mean loss of positives as 1, plus max(0, mean loss of unlabelled as 0 - prior * mean loss of positives
  as 0), with the logistic loss and a ridge; steps go up the second term while it is negative. The model is linear in
  standardised features and their squares, so the score, a logistic of it, is an estimate of the label's probability.

Null texts count as empty; empty texts get the score of their features like any other. Rows with a null id are not
held out, and train as unlabelled text. Repeated rows are drawn once and scored each. Of several labels of an id, any
that says 1 counts. Ties need no rule: the fit does not depend on the order of rows. Without positives every score is
0.5. Extra columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import small_batches, written

#: Most rows of either training sample, which the driver fits.
SAMPLE = 20_000
#: Least score of a text that is predicted to be good.
GOOD = 0.3
FOLDS = 5
STEPS, RATE, RIDGE = 600, 0.05, 1e-3
#: Standardised features are held within these bounds.
BOUND = 6.0
#: Probability with which an allowance of the prior's estimate may be too small.
DOUBT = 0.1

#: Classes of bytes whose shares of a text's bytes without white space are features.
CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"'\"`", b"()[]{}<>", b"#$%&*", b"|", b"-_/\\", b"+=~^@", bytes(range(128, 256)), bytes([*range(9), *range(14, 32), 127]))
FEATURES = (*(f"bytes_{k}" for k in range(len(CLASSES))), "words", "word_length", "upper_words", "short_words", "variety", "repeated_in_a_row", "repeated_lines", "line_words")
_MEMBER = np.zeros((256, len(CLASSES)))
for _k, _class in enumerate(CLASSES):
    _MEMBER[list(_class), _k] = 1

SAMPLED = "trusted boolean, plain boolean, features binary"
SCORED = "doc_id long, held_out boolean, score double, predicted int"


def features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES for each text."""
    found = np.zeros((len(texts), len(FEATURES)))
    counts = np.zeros((len(texts), 256))
    for row, text in enumerate(texts):
        raw = text.encode()
        counts[row] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        words = raw.split()
        n = len(words)
        if n:
            lines = [line for line in raw.split(b"\n") if line.strip()]
            different = len(set(words))
            found[row, len(CLASSES) :] = (
                np.log1p(n),
                np.log(sum(map(len, words)) / n),
                sum(map(bytes.isupper, words)) / n,
                sum(len(word) < 3 for word in words) / n,
                np.log1p(different) / np.log1p(n),
                np.log1p(100 * sum(map(operator.eq, words[1:], words)) / n),
                1 - len(set(lines)) / len(lines),
                np.log(n / len(lines)),
            )
    solid = counts @ _MEMBER
    found[:, : len(CLASSES)] = np.log1p(100 * solid / np.maximum(1, solid.sum(axis=1, keepdims=True)))
    return found


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _descend(slope, size: int) -> np.ndarray:
    """Adam from zero; slope gives the gradient at given weights. The mean of the last half of the steps damps swings."""
    weights, first, second, mean = (np.zeros(size) for _ in range(4))
    for step in range(1, STEPS + 1):
        gradient = slope(weights)
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        weights = weights - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        mean += weights * (step > STEPS // 2) / (STEPS - STEPS // 2)
    return mean


def separate(positive: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression of positive against unlabelled rows, both with the same total weight."""

    def slope(weights: np.ndarray) -> np.ndarray:
        up = -_logistic(-(positive @ weights)) @ positive / len(positive)
        down = _logistic(unlabelled @ weights) @ unlabelled / len(unlabelled)
        return up + down + RIDGE * weights

    return _descend(slope, positive.shape[1])


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled rows from the two kinds' scores: the best bin's ratio of shares."""
    cuts = np.unique(positive)
    above = lambda scores: 1 - np.searchsorted(np.sort(scores), cuts, side="left") / len(scores)
    p, u = above(positive), above(unlabelled)
    allowance = np.sqrt(np.log(4 / DOUBT) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = int(np.argmin((u + allowance) / p))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def non_negative_fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk."""

    def slope(weights: np.ndarray) -> np.ndarray:
        at_p, at_u = positive @ weights, unlabelled @ weights
        down = _logistic(at_u) @ unlabelled / len(unlabelled) - prior * _logistic(at_p) @ positive / len(positive)
        if _softplus(at_u).mean() - prior * _softplus(at_p).mean() < 0:
            return -down
        return down - prior * _logistic(-at_p) @ positive / len(positive) + RIDGE * weights

    return _descend(slope, positive.shape[1])


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def rows(self, found: np.ndarray) -> np.ndarray:
        """Standardised features, their squares and a constant."""
        z = np.clip((found - self.centre) / self.spread, -BOUND, BOUND)
        return np.hstack([z, z**2 / BOUND, np.ones((len(z), 1))])

    def score(self, found: np.ndarray) -> np.ndarray:
        return _logistic(self.rows(found) @ self.weights)


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model of two samples of features; the result doesn't depend on the order of rows."""
    positive, unlabelled = (x[np.lexsort(x.T)] for x in (positive, unlabelled))
    spread = np.maximum(unlabelled.std(axis=0), 0.01)
    blank = Model(unlabelled.mean(axis=0), spread, np.zeros(2 * len(spread) + 1), 0.5)
    p, u = blank.rows(positive), blank.rows(unlabelled)
    prior = 0.5
    if len(p) > 1 and len(u) > 1:
        weights = separate(p[::2], u[::2])
        prior = class_prior(p[1::2] @ weights, u[1::2] @ weights)
    return Model(blank.centre, spread, non_negative_fit(p, u, prior), prior)


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = features([text or "" for text in batch.column(2).to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([row.tobytes() for row in found], pa.binary())], names=["trusted", "plain", "features"])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fits on samples of the texts that are not held out; None without positives."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("good", F.lit(True))
    learnt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(~_held_out())
    n, n_good = learnt.select("doc_id").join(good, "doc_id", "left").agg(F.count("*"), F.count("good")).first()
    if not n_good:
        return None
    drawn = lambda seed, of: F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 40)) < int((1 << 40) * min(1.0, 0.95 * SAMPLE / of))
    chosen = learnt.select("doc_id", "text", drawn(1, n_good).alias("trusted"), drawn(2, n).alias("plain")).where("trusted or plain")
    marked = chosen.join(good, "doc_id", "left").select((F.col("trusted") & F.col("good").isNotNull()).alias("trusted"), "plain", "text", "doc_id").where("trusted or plain").distinct()
    rows = written(spark, marked.drop("doc_id").mapInArrow(_sample, SAMPLED), "pu-sample").toArrow()
    found = np.array([np.frombuffer(x) for x in rows.column("features").to_pylist()]).reshape(-1, len(FEATURES))
    trusted, plain = (rows.column(name).to_numpy(zero_copy_only=False).astype(bool) for name in ("trusted", "plain"))
    return fit(found[trusted], found[plain]) if trusted.any() and plain.any() else None


def _score(batches: Iterator[pa.RecordBatch], model: Model | None, good: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text or "" for text in batch.column(2).to_pylist()]
        scores = model.score(features(texts)) if model else np.full(len(texts), 0.5)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= good).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, good: float = GOOD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= good)."""
    small_batches(spark)
    model = train(spark, docs, labels)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _held_out().alias("held_out"), "text").mapInArrow(lambda batches: _score(batches, model, good), SCORED)
