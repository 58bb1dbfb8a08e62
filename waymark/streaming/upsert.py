"""A history of counts kept up to date by a stream: a versioned table whose latest day a micro-batch replaces or extends.

Each batch makes a new version of the table beside the old ones and then swaps a small pointer file, last of all, which
holds the version's folder and the batch's number. Readers follow the pointer, so they see the state before or after
a batch and nothing between. A batch that comes again, since its run was lost after the swap, is known by its number
and changes nothing; one that was lost before the swap leaves a folder that nothing points to. What append_counts refuses
(other keys than the history's, a day of another source, an older day) ends the stream before the swap.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.sources.shared import Files, remove
from waymark.stages.counts import append_counts

POINTER = "current.json"
SERIES = "geoid string, day string, n long, source string, interval string"


class VersionedSeries:
    """The table below a folder that the driver and all executors see."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2) -> None:
        self.spark, self.folder, self.keep, self.files = spark, folder.rstrip("/"), keep, Files(folder)

    def pointer(self) -> dict:
        return json.loads(self.files.read(POINTER)) if self.files.exists(POINTER) else {"version": None, "batch": -1, "earlier": []}

    def read(self) -> DataFrame:
        version = self.pointer()["version"]
        return self.spark.read.schema(SERIES).parquet(f"{self.folder}/{version}") if version else self.spark.createDataFrame([], SERIES)

    def swap(self, rows: DataFrame, batch: int) -> None:
        """Writes a version and points to it; versions that fall out of those kept are removed afterwards."""
        before = self.pointer()
        version = f"v{batch:08d}-{uuid.uuid4().hex[:8]}"
        rows.select("geoid", "day", "n", "source", "interval").write.parquet(f"{self.folder}/{version}")
        earlier = [name for name in (before["version"], *before["earlier"]) if name]
        self.files.write(POINTER, [json.dumps({"version": version, "batch": batch, "earlier": earlier[: self.keep]}).encode()])
        for name in earlier[self.keep :]:
            remove(self.spark, f"{self.folder}/{name}")

    def upsert(self, batch: DataFrame, number: int) -> None:
        """Takes a batch of (geoid, day, n, source, interval): its days in order, each as append_counts says; the last rows of a day count."""
        if number <= self.pointer()["batch"]:
            return
        days = batch.groupBy("day").agg(F.min("source").alias("source"), F.max("source").alias("other"), F.min("interval").alias("interval")).orderBy("day").collect()
        rows = self.read()
        first = self.pointer()["version"] is None
        for row in days:
            if row.source != row.other:
                raise ValueError(f"{row.day} comes from two sources, {row.source} and {row.other}")
            counts = batch.where(F.col("day") == row.day).groupBy("geoid").agg(F.max("n").alias("n"))
            rows = started(counts, row.day, row.source, row.interval) if first else append_counts(rows, counts, row.day, row.source, row.interval)
            first = False
        if days:
            self.swap(rows, number)


def started(counts: DataFrame, day: str, source: str, interval: str) -> DataFrame:
    return counts.select("geoid", F.lit(day).alias("day"), "n", F.lit(source).alias("source"), F.lit(interval).alias("interval"))


def start(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Runs a stream of (geoid, day, n, source, interval) into the table until no more is there."""
    table = VersionedSeries(stream.sparkSession, folder)
    return stream.writeStream.foreachBatch(table.upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
