"""An extension: weekly counts from a stream of events, kept in a table that a late week cannot rewrite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def weekly(events: DataFrame, time: str, by: str, late: str = "7 days") -> DataFrame:
    """(week, by, n): events per week; those later than the watermark are not counted."""
    stamped = events.withColumn(time, F.col(time).cast("timestamp"))
    counted = stamped.withWatermark(time, late).groupBy(F.window(time, "7 days", startTime="4 days").alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.date_format("w.start", "yyyy-MM-dd").alias("week"), by, "n")


def start(counts: DataFrame, table: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Appends closed weeks to a folder, one folder a batch, so that a batch that runs again replaces its own rows."""

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{table}/batch={batch}")

    return counts.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
