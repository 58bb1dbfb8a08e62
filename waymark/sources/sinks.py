"""Writers: partitioned Parquet that keeps its partition column, CSV reports, GeoJSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.tiles import EXTENT, tile_number, world_units

TAGS = ("housenumber", "street", "unit", "city", "state", "postcode")


def write_by_state(rows: DataFrame, path: str, column: str = "addr_state") -> None:
    """Zstandard Parquet in one folder per value; the files keep the column, folders are named by a copy of it.

    The rebalance lets adaptive execution split a large value's rows over tasks and put small ones together.
    """
    copied = rows.withColumn(f"in_{column}", F.col(column)).hint("rebalance", f"in_{column}")
    copied.write.mode("overwrite").option("compression", "zstd").partitionBy(f"in_{column}").parquet(path)


def read_by_state(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The table in its own column order; folders' names are text."""
    return spark.read.option("partitionColumnTypeInference.enabled", False).parquet(path).select(*columns)


def write_report(rows: DataFrame, path: str, *order) -> None:
    """A small report as one CSV file with a header."""
    (rows.orderBy(*order) if order else rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def geojson_lines(points: DataFrame) -> DataFrame:
    """(addr_state, value): one feature per kept point, with the tags that it has and no id."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    properties = F.struct(*(F.col(f"addr_{tag}").alias(f"addr:{tag}") for tag in TAGS))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))
    return points.where("drop_reason is null").select("addr_state", F.to_json(feature).alias("value"))


def write_layer(rows: DataFrame, path: str, group_bytes: int = 8 << 20, zoom: int = 14) -> None:
    """Elements with a struct bbox in the order of a space-filling curve, in small row groups, so that a reader that asks for boxes skips the others.

    The box's corner decides; statistics of the struct's fields stand with each row group.
    """
    x, y = (F.floor(v / EXTENT).cast("long") for v in world_units(F.col("bbox.xmin"), F.col("bbox.ymin"), zoom))
    placed = rows.withColumns({"zoom__": F.lit(zoom), "x__": x, "y__": y}).withColumn("place__", tile_number("zoom__", "x__", "y__"))
    placed.repartitionByRange("place__").sortWithinPartitions("place__").drop("zoom__", "x__", "y__", "place__").write.mode("overwrite").option("parquet.block.size", group_bytes).option("compression", "zstd").parquet(path)
