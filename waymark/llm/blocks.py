"""Rows by address: a block of rows of a file, and a place in it. What a block's rows have to know travels to them by files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import SharedFiles, grouped, written

BLOCK_ROWS = 4096


def addressed(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """Each row's block of BLOCK_ROWS rows of a file, its place in it, and the columns, which have other names than block and row."""
    named = docs.select(F.col("_metadata.file_path").alias("file__"), F.col("_metadata.row_index").alias("at__"), *columns)
    return named.select(F.xxhash64("file__", F.floor(F.col("at__") / BLOCK_ROWS)).alias("block"), F.pmod("at__", F.lit(BLOCK_ROWS)).cast("int").alias("row"), *named.columns[2:])


def on_files(spark: SparkSession, docs: DataFrame, label: str) -> DataFrame:
    """The documents as rows of Parquet files, written first if they are not yet."""
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return written(spark, docs, label)


def keep_by_block(batches: Iterator[pa.RecordBatch], folder: str, label: str, kind: np.dtype, order: list[str] | None) -> Iterator[pa.RecordBatch]:
    """Writes what each block's rows have to know to its own file; rows are (block, payload) in order of block."""
    files = SharedFiles(folder)
    for block, rows in grouped(batches):
        found = np.concatenate([np.frombuffer(payload, kind) for (payload,) in rows])
        found = np.sort(found, order=order) if order else np.unique(found)
        files.write(f"{label}{block}", iter([zstandard.ZstdCompressor(level=1).compress(found.tobytes())]))
        yield pa.RecordBatch.from_pylist([{"block": block, "n": len(found)}], schema=pa.schema([("block", pa.int64()), ("n", pa.int64())]))


class Kept:
    """Reads blocks' files, one at a time; a missing one is an error, since every block has one."""

    def __init__(self, folder: str, label: str, kind: np.dtype) -> None:
        self.files, self.label, self.kind = SharedFiles(folder), label, kind
        self.block, self.found = None, np.zeros(0, dtype=kind)

    def of(self, block: int) -> np.ndarray:
        if block != self.block:
            with self.files.open(f"{self.label}{block}") as file:
                self.found = np.frombuffer(zstandard.ZstdDecompressor().decompress(file.read()), self.kind)
            self.block = block
        return self.found
