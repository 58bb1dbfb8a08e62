"""Filter interaction audit: what each of five filters removes at each place of all 120 orders.

A text's failures are five bits. Four are counted from the text, in Arrow batches that also give the text's
SHA-256; the fifth, a copy of a text with a smaller id, comes from counts by digest: rows are counted by digest,
part and label before they are shuffled, so a text that a third of all rows hold is a few rows a task. A table of
32 failures by 120 orders holds the step at which each first fails; tasks look their rows up, np.bincount adds up
removals by part, order, step and label, and the tasks' partial arrays are summed.

Fixed meanings: null texts count as empty, null languages are the part ''. A row with a null id is never a copy, nor
makes one, and has no label. Rows of one id and text are no copies of each other, but all count. Of several labels of
an id, any that says 1 counts. Texts of any length are read whole; one batch holds 1,000 rows. Extra columns are
ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import small_batches

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]
STEPS = len(FILTERS)
COPY = 1 << FILTERS.index("E")
#: Parts whose arrays a task holds before it gives them out.
MOST_PARTS = 1000

MARKED = "doc_id long, part string, mask int, digest binary"
MARKED_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary())])
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PARTIAL = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in COUNTS)

_SYMBOL = re.compile(rb"[#$%&*|]")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def first_failures() -> np.ndarray:
    """For each set of failures (rows) and order (columns) the step, from 0, that removes; STEPS where none does."""
    table = np.full((1 << STEPS, len(ORDERS)), STEPS, dtype=np.int64)
    for number, order in enumerate(ORDERS):
        for step in reversed(range(STEPS)):
            fails = np.arange(1 << STEPS) >> FILTERS.index(order[step]) & 1
            table[fails == 1, number] = step
    return table


def failures(text: str) -> int:
    """The bits of filters A to D that a text fails."""
    raw = text.encode()
    words = raw.split()
    return (len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1 | (100 * (len(raw) - len(raw.translate(None, _UPPER))) > 10 * len(text)) << 2 | (_SYMBOL.search(raw) is not None) << 3


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text or "" for text in batch.column(2).to_pylist()]
        digests = [hashlib.sha256(text.encode()).digest() for text in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(map(failures, texts)), pa.int32()), pa.array(digests, pa.binary())], schema=MARKED_ARROW)


def _partial(part: str, found: np.ndarray, masks: np.ndarray) -> pa.RecordBatch:
    """A task's share of a part's rows; every column is a sum over texts, so shares add up."""
    steps = found[:, :STEPS].sum(axis=2)
    own = np.array([[FILTERS.index(letter) for letter in order] for order in ORDERS])
    fails = np.array([masks[np.arange(len(masks)) >> k & 1 == 1].sum() for k in range(STEPS)])
    alone = np.array([masks[1 << k] for k in range(STEPS)])
    shapley = np.array([steps[own == k].sum() for k in range(STEPS)])
    good, toxic = found[:, :STEPS, 1::2].sum(axis=2), found[:, :STEPS, 2:].sum(axis=2)
    columns = (masks.sum() - np.cumsum(steps, axis=1), steps, fails[own] - steps, alone[own], good, toxic, shapley[own])
    rows = len(ORDERS) * STEPS
    named = {"part": [part] * rows, "filter_order": np.repeat(ORDERS, STEPS), "step": np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))}
    return pa.RecordBatch.from_pydict({**named, **{name: column.ravel() for name, column in zip(COUNTS, columns, strict=True)}})


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are (part, mask, label, n, copies): n texts of a part, of which so many are copies."""
    table, orders = first_failures(), np.arange(len(ORDERS)) * (STEPS + 1)
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        parts = batch.column(0).to_pylist()
        mask, label, n, copies = (column.to_numpy() for column in batch.columns[1:])
        names = {part: k for k, part in enumerate(dict.fromkeys(parts))}
        of = np.array([names[part] for part in parts], dtype=np.int64)
        for part, k in names.items():
            if part not in held:
                held[part] = np.zeros((len(ORDERS), STEPS + 1, 4), dtype=np.int64), np.zeros(1 << STEPS, dtype=np.int64)
            removals, masks = held[part]
            mine = of == k
            for fails, times in ((mask[mine], (n - copies)[mine]), (mask[mine] | COPY, copies[mine])):
                cells = (orders + table[fails]) * 4 + label[mine, None]
                removals += np.bincount(cells.ravel(), np.repeat(times, len(ORDERS)), removals.size).astype(np.int64).reshape(removals.shape)
                masks += np.bincount(fails, times, masks.size).astype(np.int64)
        if len(held) > MOST_PARTS:
            yield from (_partial(part, *arrays) for part, arrays in held.items())
            held = {}
    yield from (_partial(part, *arrays) for part, arrays in held.items())


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included."""
    small_batches(spark)
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text").mapInArrow(_mark, MARKED)
    says = lambda name, value: F.max(F.when(F.col(name) == 1, value).otherwise(0))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((says("quality", 1) + says("toxic", 2)).alias("label"))
    rows = marked.join(known, "doc_id", "left").groupBy("doc_id", "part", "mask", "digest", F.coalesce("label", F.lit(0)).alias("label")).agg(F.count("*").alias("n"))
    same = rows.groupBy("digest", "part", "mask", "label", F.col("doc_id").isNull().alias("unnamed")).agg(F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("at_low"))
    first = F.min("low").over(Window.partitionBy("digest"))
    copies = F.when(F.col("unnamed"), 0).otherwise(F.col("n") - F.when(F.col("low") == first, F.col("at_low")).otherwise(0))
    counted = same.select("part", "mask", "label", "n", copies.cast("long").alias("copies")).mapInArrow(_audit, PARTIAL)
    return counted.groupBy("part", "filter_order", "step").agg(*(F.sum(name).alias(name) for name in COUNTS))
