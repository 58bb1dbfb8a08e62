"""Delimited text whose quoted values may hold line breaks, read in splits.

A line means something else where it begins inside of a quoted value. The lines of each split are read twice, with
nothing moved: the first pass finds how a split ends if it begins between records, and if it begins inside of a value; a
running sum over a file's splits says which of the two holds; the second pass gives the records that lie in one split as
a whole. Where records cross splits, the lines of these splits are read once more for what neighbours share, and put
together. Records are then parsed by the engine's own parser.

A value is quoted if a quote opens it; doubled quotes stand for one; what follows a closing quote up to the next
separator belongs to the value, as do quotes inside of values that are not quoted. Blank lines between records are
no records. A last record whose quotes never close ends with the file.
"""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits that begin inside of a value, up to which every task is told them all; beyond that they are joined.
MOST_OPEN = 100_000

SPLITS = "file string, start long, closed_to boolean, open_to boolean, header string"
PIECES = "file string, start long, k int, text string"


def line_state(separator: str, quote: str) -> Callable[[str, bool], bool]:
    """A function of a line, and whether it begins inside of a quoted value, that says whether it ends inside of one."""
    q, s = re.escape(quote), re.escape(separator)
    close = re.compile(rf"(?:[^{q}]|{q}{q})*+{q}", re.S)
    tidy = re.compile(rf"(?:{q}(?:[^{q}]|{q}{q})*+{q}|[^{q}{s}]*+)(?:{s}(?:{q}(?:[^{q}]|{q}{q})*+{q}|[^{q}{s}]*+))*+", re.S)
    opening = separator + quote

    def ends_open(line: str, opened: bool) -> bool:
        if not opened and (quote not in line or tidy.fullmatch(line.removesuffix("\r"))):
            return False
        at = 0
        while True:
            if not opened:
                if not (at == 0 and line.startswith(quote)):
                    at = line.find(opening, at)
                    if at < 0:
                        return False
                    at += len(separator)
                at += len(quote)
            found = close.match(line, at)
            if not found:
                return True
            opened = False
            at = line.find(separator, found.end())
            if at < 0:
                return False
            if not line.startswith(quote, at + len(separator)):
                at += len(separator)
    return ends_open


class _Reading:
    """Lines of a split put together to records; head and tail are those of records that it shares with its neighbours."""

    def __init__(self, opened: bool) -> None:
        self.open, self.crossing, self.head, self.tail = opened, opened, [], []

    def line(self, text: str, ends_open: Callable[[str, bool], bool]) -> str | None:
        """Takes a line; gives the record that it completes, if that began here."""
        self.open = ends_open(text, self.open)
        held = self.head if self.crossing else self.tail
        held.append(text)
        if self.open:
            return None
        if self.crossing:
            self.crossing = False
            return None
        record = "\n".join(held)
        held.clear()
        return record


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Splits (file, start) with their lines, as a stream."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    source = rows()
    pending = next(source, None)
    while pending is not None:
        split = pending[1:]

        def own() -> Iterator[str]:
            nonlocal pending
            while pending is not None and pending[1:] == split:
                line, pending = pending[0], next(source, None)
                yield line

        lines = own()
        yield split, lines
        for _ in lines:
            pass


def _first_pass(batches: Iterator[pa.RecordBatch], separator: str, quote: str) -> Iterator[pa.RecordBatch]:
    ends_open = line_state(separator, quote)
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("closed_to", pa.bool_()), ("open_to", pa.bool_()), ("header", pa.string())])
    for (file, start), lines in _lines(batches):
        header = next(lines) if start == 0 else None
        closed, opened = False, True
        for line in lines:
            same = closed == opened
            closed = ends_open(line, closed)
            opened = closed if same else ends_open(line, opened)
        yield pa.RecordBatch.from_pylist([{"file": file, "start": start, "closed_to": closed, "open_to": opened, "header": header}], schema=schema)


def _pieces(batches: Iterator[pa.RecordBatch], separator: str, quote: str) -> Iterator[pa.RecordBatch]:
    """What splits share with their neighbours, k being 0 at their beginnings; rows are (value, file, start, opened)."""
    ends_open = line_state(separator, quote)
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("k", pa.int32()), ("text", pa.string())])
    for (file, start, opened), lines in _lines(batches):
        if start == 0:
            next(lines)
        reading = _Reading(opened)
        for line in lines:
            reading.line(line, ends_open)
        found = [{"file": file, "start": start, "k": k, "text": "\n".join(held)} for k, held in enumerate((reading.head, reading.tail)) if held]
        yield pa.RecordBatch.from_pylist(found, schema=schema)


def _second_pass(batches: Iterator[pa.RecordBatch], separator: str, quote: str, opened: frozenset) -> Iterator[pa.RecordBatch]:
    ends_open = line_state(separator, quote)
    for (file, start), lines in _lines(batches):
        if start == 0:
            next(lines)
        reading, found = _Reading((file, start) in opened), []
        for line in lines:
            record = reading.line(line, ends_open)
            if record is not None:
                found.append(record)
            if len(found) >= 1000:
                yield pa.RecordBatch.from_pydict({"record": pa.array(found, pa.string())})
                found = []
        yield pa.RecordBatch.from_pydict({"record": pa.array(found, pa.string())})


def headers(splits: DataFrame, separator: str, quote: str) -> list[list[str]]:
    """The different headers of the files."""
    quoting = {"quotechar": quote} if quote else {"quoting": csv.QUOTE_NONE}
    rows = splits.where("header is not null").select("header").distinct().limit(100).collect()
    return [next(csv.reader([row.header.removeprefix("﻿").rstrip("\r")], delimiter=separator, **quoting), []) for row in rows]


def with_states(splits: DataFrame) -> DataFrame:
    """The splits with opened, whether they begin inside of a value.

    A split either ends the same way however it begins, or keeps the state, or turns it: a split's state is the last
    end that was fixed, turned as often as since then.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("closed_to") & ~F.col("open_to")).cast("int"))
    own = splits.withColumn("turned", F.coalesce(turns.over(before), F.lit(0)))
    own = own.withColumn("turned_by_end", F.col("turned") + (F.col("closed_to") & ~F.col("open_to")).cast("int"))
    fixed = F.when(F.col("closed_to") == F.col("open_to"), F.struct(F.col("closed_to").cast("int").alias("state"), "turned_by_end"))
    last = F.last(fixed, ignorenulls=True).over(before)
    own = own.withColumn("fixed", last)
    state = F.pmod(F.coalesce("fixed.state", F.lit(0)) + F.col("turned") - F.coalesce("fixed.turned_by_end", F.lit(0)), F.lit(2))
    return own.withColumn("opened", state == 1).drop("turned", "turned_by_end", "fixed")


def crossing(lines: DataFrame, shared: DataFrame, separator: str, quote: str) -> DataFrame:
    """(record): records that lie in several splits, or end with the file; shared are the splits (file, start, opened) with some."""
    some = lines.withColumn("place", F.monotonically_increasing_id()).join(shared, ["file", "start"])
    dealt = some.repartition("file", "start").sortWithinPartitions("file", "start", "place").select("value", "file", "start", "opened")
    pieces = dealt.mapInArrow(lambda batches: _pieces(batches, separator, quote), PIECES)
    begun = F.sum("k").over(Window.partitionBy("file").orderBy("start", "k"))
    whole = pieces.withColumn("n", begun).groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("start", "k", "text"))).alias("found"))
    return whole.select(F.array_join(F.transform("found", lambda p: p["text"]), "\n").alias("record"))


def read_quoted(spark: SparkSession, path: str, columns: Sequence[str], check: Callable[[list[str]], None], separator: str = ",", quote: str = '"') -> DataFrame:
    """The files' records as text columns; check is given each different header."""
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    splits = with_states(lines.mapInArrow(lambda batches: _first_pass(batches, separator, quote), SPLITS))
    splits = splits.withColumn("run", F.lit(uuid.uuid4().hex)).persist()  # a later read of the same files must not meet this one's rows
    try:
        for header in headers(splits, separator, quote):
            check(header)
    except ValueError:
        splits.unpersist()
        raise
    opened = splits.where("opened").select("file", "start")
    known = opened.limit(MOST_OPEN + 1).collect()
    if len(known) <= MOST_OPEN:
        inside = frozenset((row.file, row.start) for row in known)
        whole = lines.mapInArrow(lambda batches: _second_pass(batches, separator, quote, inside), "record string")
    else:  # a flag for each line; the lines of a split are put back in their order
        flagged = lines.withColumn("k", F.monotonically_increasing_id()).join(opened.withColumn("inside", F.lit(True)), ["file", "start"], "left")
        dealt = flagged.repartition("file", "start").sortWithinPartitions("file", "start", "k").select("value", "file", "start", F.coalesce("inside", F.lit(False)).alias("inside"))
        whole = dealt.mapInArrow(lambda batches: _flagged(batches, separator, quote), "record string")
    ends_open = F.when(F.col("opened"), F.col("open_to")).otherwise(F.col("closed_to"))
    shared = splits.where(F.col("opened") | ends_open).select("file", "start", "opened")
    records = whole if shared.isEmpty() else whole.unionByName(crossing(lines, shared, separator, quote))
    records = records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in columns)
    parsed = F.from_csv("record", schema, {"sep": separator, "quote": quote, "escape": quote, "multiLine": "true"})
    return records.select(parsed.alias("r")).select("r.*")


def _flagged(batches: Iterator[pa.RecordBatch], separator: str, quote: str) -> Iterator[pa.RecordBatch]:
    """The second pass over lines that say themselves whether their split begins inside of a value."""
    for batch in batches:
        inside = frozenset((file, start) for file, start, flag in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True) if flag)
        break
    else:
        return
    seen = set(inside)

    def rest() -> Iterator[pa.RecordBatch]:
        yield batch.select([0, 1, 2])
        for more in batches:
            seen.update((file, start) for file, start, flag in zip(*(more.column(k).to_pylist() for k in (1, 2, 3)), strict=True) if flag)
            yield more.select([0, 1, 2])

    yield from _second_pass(rest(), separator, quote, seen)
