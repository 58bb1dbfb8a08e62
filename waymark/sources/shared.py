"""Folders that the driver and all executors see, and binary files in them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession

CHUNK = 4 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or else the context's checkpoint folder; a local session has one below /tmp."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    given = context._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    return "file:///tmp/waymark-shared"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's name below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Files:
    """Files below a folder. A file is written aside and renamed when complete, so a task that runs again does no harm."""

    def __init__(self, folder: str) -> None:
        from pyarrow import fs

        self.folder = folder
        self.store, self.base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")

    def write(self, name: str, parts: Iterable[bytes]) -> int:
        self.store.create_dir(self.base, recursive=True)
        draft, size = f"{self.base}/.{name}.{uuid.uuid4().hex}", 0
        with self.store.open_output_stream(draft) as out:
            for part in parts:
                out.write(part)
                size += len(part)
        self.store.move(draft, f"{self.base}/{name}")
        return size

    def exists(self, name: str) -> bool:
        return bool(self.store.get_file_info(f"{self.base}/{name}").is_file)

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        with self.store.open_input_file(f"{self.base}/{name}") as source:
            return source.read_at(source.size() - offset if length is None else length, offset)

    def parts(self, name: str) -> Iterator[bytes]:
        with self.store.open_input_stream(f"{self.base}/{name}") as source:
            while part := source.read(CHUNK):
                yield part
