"""What the corpus operators share: folders that all executors see, and table access."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Only used where the cluster names no folder, as in local tests.
LOCAL_DEFAULT = "/tmp/checkpoints"


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or set as the context's checkpoint folder; a fresh local one for a local session without either."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if getattr(context, "_waymark_root", None):
        return context._waymark_root
    given = context._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    context._waymark_root = f"file://{LOCAL_DEFAULT}/waymark-{uuid.uuid4().hex[:12]}"
    atexit.register(shutil.rmtree, local_path(context._waymark_root), ignore_errors=True)
    context.setCheckpointDir(context._waymark_root)
    return context._waymark_root


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared root; the caller's job owns it."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str | None:
    """The path of a file: URI or bare path, else None."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path)
    return None


class SharedFiles:
    """Binary files below a shared folder, from any executor.

    Plain files are written under a temporary name and renamed, so a task that is run again replaces its
    own earlier output and readers never see half a file. Other stores go through pyarrow's file systems,
    which publish a file when it is closed.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.local = local_path(folder)
        self.remote = None
        if self.local is None:
            from pyarrow import fs

            self.remote, self.base = fs.FileSystem.from_uri(folder)

    def write(self, name: str, parts: Iterator[bytes]) -> int:
        size = 0
        if self.local is not None:
            os.makedirs(self.local, exist_ok=True)
            target, draft = f"{self.local}/{name}", f"{self.local}/.{name}.{uuid.uuid4().hex}"
            with open(draft, "wb") as out:
                for part in parts:
                    size += out.write(part)
            os.replace(draft, target)
            return size
        self.remote.create_dir(self.base, recursive=True)
        with self.remote.open_output_stream(f"{self.base}/{name}") as out:
            for part in parts:
                out.write(part)
                size += len(part)
        return size

    def open(self, name: str):
        if self.local is not None:
            return open(f"{self.local}/{name}", "rb")
        return self.remote.open_input_file(f"{self.base}/{name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows written once to the shared folder and read again: cuts lineage and survives lost executors."""
    at = shared_folder(spark, label)
    rows.write.parquet(at)
    made = spark.read.schema(rows.schema).parquet(at)
    made._waymark_at = at
    return made


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Removes written tables that no later step reads; what was made from them has been written."""
    for rows in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(rows._waymark_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exchanged(rows: DataFrame) -> DataFrame:
    """Rows that grow with the input and are joined by exchange, whatever size Spark expects of either side.

    What arrays explode to and what compresses well is taken for much less than it is; broadcast, it would go through the driver.
    """
    return rows.hint("merge")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds what one Arrow batch holds; texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Consecutive rows of each first column's value, as a stream."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    source = rows()
    pending = next(source, None)
    while pending is not None:
        key = pending[0]

        def same() -> Iterator[tuple]:
            nonlocal pending
            while pending is not None and pending[0] == key:
                row, pending = pending, next(source, None)
                yield row[1:]

        group = same()
        yield key, group
        for _ in group:
            pass
