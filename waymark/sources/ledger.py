"""Answers of a slow service, kept by what was asked: a run that was lost asks only for what is missing."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.sources.shared import Files


def _name(body: str) -> str:
    return f"{hashlib.sha256(body.encode()).hexdigest()}.json"


def _fill(batches: Iterator[pa.RecordBatch], folder: str, ask: Callable[[str], str]) -> Iterator[pa.RecordBatch]:
    files = Files(folder)
    for batch in batches:
        for body in batch.column(0).to_pylist():
            if not files.exists(_name(body)):
                files.write(_name(body), [ask(body).encode()])
                yield pa.RecordBatch.from_pydict({"asked": [_name(body)]})


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files = Files(folder)
    for batch in batches:
        answers = [files.read(_name(body)).decode() for body in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], names=["key", "body", "answer"])


def answered(requests: DataFrame, folder: str, ask: Callable[[str], str], side_by_side: int = 4) -> DataFrame:
    """(key, body, answer) of requests (key, body).

    Each different body is asked for once, by at most so many tasks at a time as the service bears, and its answer is
    written to the folder under the body's hash as soon as it comes. What is there already isn't asked for again.
    """
    bodies = requests.select("body").distinct().repartition(side_by_side, F.xxhash64("body"))
    bodies.mapInArrow(lambda batches: _fill(batches, folder, ask), "asked string").write.format("noop").mode("overwrite").save()
    return requests.select(F.col("key").cast("string").alias("key"), "body").mapInArrow(lambda batches: _read(batches, folder), "key string, body string, answer string")
