"""Polygon layers, GeoJSON or shapefiles, as DataFrames of rings."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.memo import apply_rule

_PAIR = T.ArrayType(T.DoubleType())
_POLYGON = T.ArrayType(T.ArrayType(_PAIR))
_MULTI = T.ArrayType(_POLYGON)


def read_geojson(spark: SparkSession, path: str, attributes: list[str]) -> DataFrame:
    """The attributes as text and the rings of every (multi)polygon; holes and parts are rings like others."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "features array<string>").alias("c")).select(F.explode("c.features").alias("f"))
    fields = [F.get_json_object("f", f"$.properties.{name}").alias(name) for name in attributes]
    kind, body = F.get_json_object("f", "$.geometry.type"), F.get_json_object("f", "$.geometry.coordinates")
    own = raw.select(*fields, kind.alias("kind"), body.alias("body")).where(F.col("kind").isin("Polygon", "MultiPolygon"))
    parts = F.when(F.col("kind") == "Polygon", F.from_json("body", _POLYGON)).otherwise(F.flatten(F.from_json("body", _MULTI)))
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    return own.select(*attributes, F.transform(parts, lambda ring: F.transform(ring, point)).alias("rings"))


def shape_rings(raw: bytes) -> Iterator[list[list[dict]]]:
    """The rings of each record of a .shp file of polygons; a null shape has none."""
    at = 100
    while at + 8 <= len(raw):
        size = 2 * struct.unpack_from(">i", raw, at + 4)[0]
        body = raw[at + 8 : at + 8 + size]
        at += 8 + size
        if struct.unpack_from("<i", body)[0] not in (5, 15, 25):
            yield []
            continue
        parts, points = struct.unpack_from("<2i", body, 36)
        starts = [*struct.unpack_from(f"<{parts}i", body, 44), points]
        flat = struct.unpack_from(f"<{2 * points}d", body, 44 + 4 * parts)
        yield [[{"x": x, "y": y} for x, y in zip(flat[2 * a : 2 * b : 2], flat[2 * a + 1 : 2 * b : 2], strict=True)] for a, b in zip(starts[:-1], starts[1:], strict=True)]


def table_rows(raw: bytes) -> Iterator[dict[str, str]]:
    """The records of a .dbf file, all values as text."""
    count, head, width = struct.unpack_from("<IHH", raw, 4)
    fields, at = [], 32
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(), raw[at + 16]))
        at += 32
    for k in range(count):
        at = head + k * width + 1
        row = {}
        for name, size in fields:
            value = raw[at : at + size]
            at += size
            try:
                row[name] = value.decode().strip()
            except UnicodeDecodeError:
                row[name] = value.decode("latin-1").strip()
        yield row


def read_shapefile(spark: SparkSession, stem: str, attributes: list[str]) -> DataFrame:
    """The attributes as text and the rings of stem.shp and stem.dbf; a layer is a pair of files that one task reads."""
    content = lambda kind: spark.read.format("binaryFile").load(f"{stem}.{kind}").select(F.lit(stem).alias("stem"), F.col("content").alias(kind))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shp, dbf in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [{**{name: row.get(name) for name in attributes}, "rings": rings} for row, rings in zip(table_rows(dbf), shape_rings(shp), strict=False)]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([*((name, pa.string()) for name in attributes), ("rings", pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))]))

    schema = T.StructType([*(T.StructField(name, T.StringType()) for name in attributes), T.StructField("rings", T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))))])
    return content("shp").join(content("dbf"), "stem").select("shp", "dbf").mapInArrow(parsed, schema).where(F.size("rings") > 0)


def layer(rows: DataFrame, name: str, state: str | None = None, where: str = "true") -> DataFrame:
    """(state, name, rings) of a layer's rows that meet a condition; without a state column it is null."""
    kept = rows.where(where)
    return kept.select((F.col(state) if state else F.lit(None).cast("string")).alias("state"), F.col(name).alias("name"), "rings")


def renamed(shapes: DataFrame, rule: Callable[[Column], Column]) -> DataFrame:
    """The shapes with a rule on their names; it sees each name once."""
    return apply_rule(shapes, ["name"], rule, "name__").withColumn("name", F.coalesce("name__", "name")).drop("name__")
