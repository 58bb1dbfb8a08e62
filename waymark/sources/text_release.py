"""Readers for text releases: a strict header, every value as text."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.sources.quoted_text import headers, read_quoted

CHUNK = 4 << 20
DEFLATE64 = 9


def text_member(archive: zipfile.ZipFile, pattern: str = r"(?:^|/)[A-Z]+_r(\d+)\.txt$") -> tuple[zipfile.ZipInfo, str]:
    """The one release file of an archive, and the release's name."""
    found = [(info, match) for info in archive.infolist() if (match := re.search(pattern, info.filename))]
    if len(found) != 1:
        raise ValueError(f"expected one release file, found {[info.filename for info, _ in found]}")
    return found[0][0], f"r{found[0][1][1]}"


def member_bytes(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> Iterator[bytes]:
    """A member's content in pieces: stored, deflated, or Deflate64 where the inflate64 module is installed."""
    if info.compress_type != DEFLATE64:
        with archive.open(info) as source:
            while chunk := source.read(CHUNK):
                yield chunk
        return
    from inflate64 import Inflater

    inflater, raw = Inflater(), archive.fp
    raw.seek(info.header_offset + 26)
    names = int.from_bytes(raw.read(2), "little") + int.from_bytes(raw.read(2), "little")
    raw.seek(info.header_offset + 30 + names)
    left = info.compress_size
    while left:
        part = raw.read(min(CHUNK, left))
        left -= len(part)
        yield inflater.inflate(part)


def unpack(archive: str | Path, folder: str | Path) -> tuple[Path, str]:
    """Writes the release file next to nothing else; a complete earlier copy is kept."""
    with zipfile.ZipFile(archive) as opened:
        info, release = text_member(opened)
        target = Path(folder) / Path(info.filename).name
        if target.exists() and target.stat().st_size == info.file_size:
            return target, release
        target.parent.mkdir(parents=True, exist_ok=True)
        draft = target.with_suffix(".part")
        with draft.open("wb") as out:
            for part in member_bytes(opened, info):
                out.write(part)
        if draft.stat().st_size != info.file_size:
            raise ValueError(f"{info.filename}: {draft.stat().st_size} bytes, {info.file_size} expected")
        draft.rename(target)
    return target, release


def header_problems(header: Sequence[str], expected: Sequence[str]) -> list[str]:
    """What is missing, new or out of order; nothing if the header is as expected."""
    missing, new = [c for c in expected if c not in header], [c for c in header if c not in expected]
    problems = [f"missing: {', '.join(missing)}"] * bool(missing) + [f"new: {', '.join(new)}"] * bool(new)
    if not problems and list(header) != list(expected):
        problems.append("reordered: " + ", ".join(f"{a} is where {b} was" for a, b in zip(header, expected, strict=True) if a != b))
    return problems


def read_text(spark: SparkSession, path: str, columns: Sequence[str], separator: str = ",", quote: str = '"', line_breaks: bool = False, splits: bool = True) -> DataFrame:
    """Delimited files as text columns; empty values are null, a header of any file that differs is an error.

    line_breaks: quoted values may hold line breaks; files are read in splits all the same, see quoted_text, or with
    splits=False by one task each.
    """

    def check(header: list[str]) -> None:
        if problems := header_problems(header, columns):
            raise ValueError(f"{path}: {'; '.join(problems)}")

    if line_breaks and splits and quote:
        return read_quoted(spark, path, columns, check, separator, quote)
    first = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")).where("start = 0")
    heads = first.mapInArrow(_first_lines, "header string").distinct()
    for header in headers(heads, separator, quote):
        check(header)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.schema(schema).options(header=True, sep=separator, quote=quote, escape='"', multiLine=line_breaks, enforceSchema=True).csv(path)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each file, once its first split's lines come."""
    last = None
    for batch in batches:
        files = batch.column(1).to_pylist()
        for place, file in enumerate(files):
            if file != last:
                last = file
                yield pa.RecordBatch.from_pydict({"header": [batch.column(0)[place].as_py()]})
