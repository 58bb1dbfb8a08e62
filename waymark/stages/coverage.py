"""Points per county and source: binned first, so that some millions of bins are placed in place of all points."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import single_origin
from waymark.functions.outlines import geometry, simpler_ring
from waymark.operators import spatial

# Fixed values, in degrees: bins a degree, reach of a county's border, tolerance and grid of its outline.
BINS_PER_DEGREE, SNAP = 100, 0.05
TOLERANCE, GRID = 0.01, 0.0001


def binned(points: DataFrame, per_degree: int = BINS_PER_DEGREE) -> DataFrame:
    """(bin, source, lon, lat, points) of kept points: a bin's place is the mean of its points."""
    cell = lambda c: F.round(F.col(c) * per_degree).cast("long")
    grouped = points.where("drop_reason is null").groupBy(F.col("nad_source").alias("source"), cell("lon").alias("gx"), cell("lat").alias("gy"))
    own = grouped.agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count(F.lit(1)).alias("points"))
    return own.select(F.concat_ws("/", "gx", "gy", F.coalesce("source", F.lit(""))).alias("bin"), "source", "lon", "lat", "points")


def placed_bins(bins: DataFrame, counties: DataFrame, snap: float = SNAP) -> DataFrame:
    """The bins with geoid: of the county that holds them, else of the nearest within reach, else null."""
    shapes = counties.select("geoid", "rings")
    inside = spatial.points_in_polygons(bins, shapes, "bin", "geoid")
    outside = bins.join(inside.select("bin"), "bin", "left_anti")
    snapped = spatial.nearest_polygon(outside, shapes, "bin", "geoid", snap).select("bin", "geoid")
    return bins.join(inside.unionByName(snapped), "bin", "left")


def county_counts(bins: DataFrame) -> DataFrame:
    """(geoid, source, points); a null geoid counts what lies in no county."""
    return bins.groupBy("geoid", "source").agg(F.sum("points").alias("points"))


def county_summary(counts: DataFrame, others: Sequence[str]) -> DataFrame:
    """(geoid, points, own, other, origin, sources) of counties with points; others are the ids of extra sources."""
    extra = F.col("source").isin(*others) if others else F.lit(False)
    part = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("points"))), F.lit(0).cast("long"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("points")).alias("less"), F.col("source").alias("id"), "points")))
    own = counts.where("geoid is not null").groupBy("geoid").agg(F.sum("points").alias("points"), part(~F.coalesce(extra, F.lit(False))).alias("own"), part(extra).alias("other"), listed.alias("listed"))
    return own.select("geoid", "points", "own", "other", single_origin(F.col("own"), F.col("other")).alias("origin"), F.transform("listed", lambda x: F.struct(x["id"].alias("id"), x["points"].alias("points"))).alias("sources"))


def source_totals(counts: DataFrame) -> DataFrame:
    return counts.where("geoid is not null").groupBy("source").agg(F.sum("points").alias("points")).orderBy(F.desc("points"))


POINT = "struct<x:double,y:double>"


def border_points(shapes: DataFrame) -> DataFrame:
    """(p): points where borders of shapes (geoid, rings) meet or end, as the shapes beside them are not the same on both sides."""
    steps = F.flatten(F.transform("rings", lambda ring: F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, i + 1).alias("b")))))
    edges = shapes.select("geoid", F.explode(steps).alias("e")).select("geoid", F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b"))
    borders = edges.groupBy("a", "b").agg(F.sort_array(F.collect_set("geoid")).alias("sides"))
    at = borders.select(F.explode(F.array("a", "b")).alias("p"), "sides").groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.size(F.collect_set("sides")).alias("kinds"))
    return at.where("n <> 2 or kinds <> 1").select("p")


def _simpler_rings(batches: Iterator[pa.RecordBatch], tolerance: float, grid: float) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("geoid", pa.string()), ("ring", pa.int32()), ("points", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))])
    for batch in batches:
        rows = []
        for geoid, number, points in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            ring = [(p["x"], p["y"]) for p in points]
            made = simpler_ring([*ring, ring[0]], {at for at, p in zip(ring, points, strict=True) if p["cut"]}, tolerance, grid)
            if made:
                rows.append({"geoid": geoid, "ring": number, "points": [{"x": x, "y": y} for x, y in made]})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def simplified_shapes(shapes: DataFrame, tolerance: float = TOLERANCE, grid: float = GRID) -> DataFrame:
    """(geoid, rings) of shapes (geoid, rings): outlines of fewer points whose common borders stay common. A task works on a ring at a time."""
    rings = shapes.select("geoid", F.posexplode("rings").alias("ring", "points"))
    points = rings.select("geoid", "ring", F.posexplode(F.slice("points", F.lit(1), F.size("points") - 1)).alias("k", "p"))
    cut = points.join(border_points(shapes).withColumn("cut", F.lit(True)), "p", "left")
    whole = cut.groupBy("geoid", "ring").agg(F.array_sort(F.collect_list(F.struct("k", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.coalesce("cut", F.lit(False)).alias("cut")))).alias("points"))
    made = whole.mapInArrow(lambda batches: _simpler_rings(batches, tolerance, grid), f"geoid string, ring int, points array<{POINT}>")
    return made.groupBy("geoid").agg(F.transform(F.array_sort(F.collect_list(F.struct("ring", "points"))), lambda r: r["points"]).alias("rings"))


def _feature(properties: str, rings: list) -> str:
    shape = geometry([[(p["x"], p["y"]) for p in ring] for ring in rings])
    return f'{{"type":"Feature","properties":{properties},"geometry":{json.dumps(shape, separators=(",", ":"))}}}'


def features(summary: DataFrame, counties: DataFrame) -> DataFrame:
    """(geoid, feature): the viewer's features as text, made in tasks; counties: (geoid, name, state, rings)."""
    named = summary.join(counties.select("geoid", "name", "state"), "geoid").join(simplified_shapes(counties.select("geoid", "rings")), "geoid", "left")
    properties = F.to_json(F.struct("geoid", "name", "state", "points", "own", "other", "origin", "sources"))
    made = F.udf(_feature, "string", useArrow=True)
    return named.select("geoid", made(properties, F.coalesce("rings", F.array().cast(f"array<array<{POINT}>>"))).alias("feature"))


def coverage_geojson(summary: DataFrame, counties: DataFrame, totals: DataFrame, unassigned: int, release: str, sources: dict[str, dict] | None = None) -> str:
    """The feature collection of a viewer: some thousands of finished features are put behind one another."""
    listed = {row.source: {"kind": "own", "name": row.source, **(sources or {}).get(row.source, {}), "points": row.points} for row in totals.collect()}
    whole = sum(entry["points"] for entry in listed.values()) + unassigned
    head = json.dumps({"type": "FeatureCollection", "release": release, "points": whole, "unassigned": unassigned, "sources": listed}, separators=(",", ":"))
    made = ",".join(row.feature for row in features(summary, counties).orderBy("geoid").toLocalIterator())
    return f'{head[:-1]},"features":[{made}]}}'
