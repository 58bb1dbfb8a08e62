"""Spatial joins by grid cells: a cell is an equi-join key, the exact test follows.

Polygons are arrays of rings, each an array of struct<x, y> that ends where it starts. Containment is by even-odd
crossing over all rings, so holes and parts need no special care.

For containment the cells are a quadtree's: those of half a degree are split, if any has to be, until they hold MOST_EDGES
edges at most or are DEEPEST levels below. A cell knows only the edges that reach it and whether its upper right corner lies in the polygon;
a point's test goes right to the cell's side and up to that corner and counts the edges on its way. So no test's work
grows with a polygon's corners. The grid lines lie between the ten-millionths of a degree that positions are given in, so no
corner is on one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Degrees of a cell's side.
CELL = 0.5
#: Positions have seven decimals; and a bound of the relative error of a product of two differences of doubles.
GRID, ROUNDING = 1e7, 1e-14
#: The quadtree: degrees of a side of its largest cells, where lines lie between positions, the levels below (a 128th of a
#: degree), and the edges up to which a cell is not split.
TOP, BETWEEN, DEEPEST, MOST_EDGES = 0.5, 4e-8, 6, 64


def _edges(rings: Column) -> Column:
    """All edges of all rings as struct<a, b>."""
    of_ring = lambda ring: F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, i + 1).alias("b")))
    return F.flatten(F.transform(rings, of_ring))


def crosses_odd(x: Column, y: Column, edges: Column) -> Column:
    hit = lambda e: ((e.a.y > y) != (e.b.y > y)) & (x < (e.b.x - e.a.x) * (y - e.a.y) / F.when(e.b.y == e.a.y, F.lit(1.0)).otherwise(e.b.y - e.a.y) + e.a.x)
    return F.size(F.filter(edges, hit)) % 2 == 1


def on_edge(x: Column, y: Column, edges: Column) -> Column:
    """Whether a point lies on an edge. Where the products of doubles are too close to tell, whole numbers of GRID decide."""
    whole = lambda v: F.round(v * GRID).cast("long").cast("decimal(11,0)")

    def hit(e: Column) -> Column:
        one, other = (e.b.x - e.a.x) * (y - e.a.y), (e.b.y - e.a.y) * (x - e.a.x)
        close = F.abs(one - other) <= ROUNDING * (F.abs(one) + F.abs(other))
        exact = (whole(e.b.x) - whole(e.a.x)) * (whole(y) - whole(e.a.y)) == (whole(e.b.y) - whole(e.a.y)) * (whole(x) - whole(e.a.x))
        return close & x.between(F.least(e.a.x, e.b.x), F.greatest(e.a.x, e.b.x)) & y.between(F.least(e.a.y, e.b.y), F.greatest(e.a.y, e.b.y)) & exact

    return F.exists(edges, hit)


def edge_distance(x: Column, y: Column, edges: Column) -> Column:
    """The least distance, in degrees, to any edge."""

    def to(e: Column) -> Column:
        dx, dy = e.b.x - e.a.x, e.b.y - e.a.y
        length = dx * dx + dy * dy
        t = F.when(length == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - e.a.x) * dx + (y - e.a.y) * dy) / length)))
        px, py = e.a.x + t * dx - x, e.a.y + t * dy - y
        return F.sqrt(px * px + py * py)

    return F.array_min(F.transform(edges, to))


def in_cells(polygons: DataFrame, pad: float, cell: float = CELL) -> DataFrame:
    """Polygons once for each grid cell that an edge of theirs comes within pad of: cx, cy, edges (those that do)."""
    points = F.flatten("rings")
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    span = lambda values: F.sequence(F.floor((F.array_min(values) - pad) / cell), F.floor((F.array_max(values) + pad) / cell))
    every = polygons.withColumn("edges", _edges(F.col("rings"))).withColumn("cx", F.explode(span(xs))).withColumn("cy", F.explode(span(ys)))
    left, low, side = F.col("cx") * cell - pad, F.col("cy") * cell - pad, cell + 2 * pad
    near = lambda e: (F.greatest(e.a.y, e.b.y) >= low) & (F.least(e.a.y, e.b.y) <= low + side) & (F.greatest(e.a.x, e.b.x) >= left) & (F.least(e.a.x, e.b.x) <= left + side)
    return every.withColumn("edges", F.filter("edges", near)).where(F.size("edges") > 0)


def _right_of(edges: Column, x: Column, y: Column, upto: Column) -> Column:
    """How many edges cross the line from a point to the right, as far as upto."""

    def hit(e: Column) -> Column:
        at = (e.b.x - e.a.x) * (y - e.a.y) / F.when(e.b.y == e.a.y, F.lit(1.0)).otherwise(e.b.y - e.a.y) + e.a.x
        return ((e.a.y > y) != (e.b.y > y)) & (x < at) & (at <= upto)

    return F.size(F.filter(edges, hit))


def _above(edges: Column, x: Column, y: Column, upto: Column) -> Column:
    """How many edges cross the line from a point upwards, as far as upto."""

    def hit(e: Column) -> Column:
        at = (e.b.y - e.a.y) * (x - e.a.x) / F.when(e.b.x == e.a.x, F.lit(1.0)).otherwise(e.b.x - e.a.x) + e.a.y
        return ((e.a.x > x) != (e.b.x > x)) & (y < at) & (at <= upto)

    return F.size(F.filter(edges, hit))


def _line(number: Column, level: int) -> Column:
    """Where a grid line of a level is."""
    return number * (TOP / 2**level) + BETWEEN


def _turned(odd: Column, crossed: Column) -> Column:
    return odd != (crossed % 2 == 1)


def tree_cells(polygons: DataFrame, most: int = MOST_EDGES, deepest: int = DEEPEST) -> tuple[DataFrame, int]:
    """Polygons once for each of their cells (level, cx, cy, right, top, edges, odd; cells outside are left out), and the deepest level of any."""
    points = F.flatten("rings")
    span = lambda values: F.sequence(F.floor((F.array_min(values) - BETWEEN) / TOP), F.floor((F.array_max(values) - BETWEEN) / TOP))
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    every = polygons.where(F.size(points) > 0).withColumn("edges", _edges(F.col("rings"))).withColumn("cx", F.explode(span(xs))).withColumn("cy", F.explode(span(ys))).drop("rings")
    own = every.withColumns({"level": F.lit(0), "odd": crosses_odd(_line(F.col("cx") + 1, 0), _line(F.col("cy") + 1, 0), F.col("edges"))})
    own = own.withColumn("edges", _reaching(F.col("edges"), F.col("cx"), F.col("cy"), 0)).where("odd or size(edges) > 0")
    level = 0
    while level < deepest and (own.agg(F.max(F.size("edges"))).first()[0] or 0) > most:
        own = _split(own, level, most)
        level += 1
    size = F.lit(TOP) / F.pow(F.lit(2.0), F.col("level"))
    return own.withColumns({"right": (F.col("cx") + 1) * size + BETWEEN, "top": (F.col("cy") + 1) * size + BETWEEN}), level


def _reaching(edges: Column, cx: Column, cy: Column, level: int) -> Column:
    """The edges that may come into a cell."""
    west, east, south, north = _line(cx, level), _line(cx + 1, level), _line(cy, level), _line(cy + 1, level)
    return F.filter(edges, lambda e: (F.least(e.a.x, e.b.x) <= east) & (F.greatest(e.a.x, e.b.x) >= west) & (F.least(e.a.y, e.b.y) <= north) & (F.greatest(e.a.y, e.b.y) >= south))


def _split(cells: DataFrame, level: int, most: int) -> DataFrame:
    """The cells with those of the level that hold more than most edges in four; whether a part's corner lies inside is found on the way to the whole's."""
    cx, cy, edges, odd = (F.col(c) for c in ("cx", "cy", "edges", "odd"))
    right, top = _line(cx + 1, level), _line(cy + 1, level)

    def part(dx: int, dy: int) -> Column:
        x, y = 2 * cx + dx, 2 * cy + dy
        east, north = _line(x + 1, level + 1), _line(y + 1, level + 1)
        inside = odd if dx else _turned(odd, _right_of(edges, east, north, right))
        inside = inside if dy else _turned(inside, _above(edges, right, north, top))
        return F.struct(F.lit(level + 1).alias("level"), x.alias("cx"), y.alias("cy"), _reaching(edges, x, y, level + 1).alias("edges"), inside.alias("odd"))

    whole = F.struct("level", "cx", "cy", "edges", "odd")
    parts = F.when((F.col("level") == level) & (F.size(edges) > most), F.array(*(part(dx, dy) for dx in (0, 1) for dy in (0, 1)))).otherwise(F.array(whole))
    others = [c for c in cells.columns if c not in ("level", "cx", "cy", "edges", "odd")]
    # an outer explode: for the other kind a filter would be inferred that makes the array again
    return cells.select(*others, F.explode_outer(parts).alias("cell")).select(*others, "cell.*").where("odd or size(edges) > 0")


def points_in_polygons(points: DataFrame, polygons: DataFrame, key: str, name: str, by: Sequence[str] = (), boundary: bool = False, most: int = MOST_EDGES, deepest: int = DEEPEST) -> DataFrame:
    """(key, name): the smallest name among the polygons that hold a point (lon, lat); points outside are absent.

    by: columns that must agree. boundary: points on an edge are inside too. A point looks for its cell once for each
    level that the polygons' cells may be of, which mostly is one.
    """
    cells, last = tree_cells(polygons.select(name, "rings", *by), most, deepest)
    at = lambda c, level: F.floor((F.col(c) - BETWEEN) / (TOP / 2**level))
    places = F.array(*(F.struct(F.lit(level).alias("level"), at("lon", level).alias("cx"), at("lat", level).alias("cy")) for level in range(last + 1)))
    placed = points.select(key, "lon", "lat", *by, F.explode(places).alias("cell")).select(key, "lon", "lat", *by, "cell.*") if last else points.select(key, "lon", "lat", *by, F.lit(0).alias("level"), at("lon", 0).alias("cx"), at("lat", 0).alias("cy"))
    pairs = placed.join(cells, ["level", "cx", "cy", *by])
    x, y, edges = F.col("lon"), F.col("lat"), F.col("edges")
    inside = _turned(F.col("odd"), _right_of(edges, x, y, F.col("right")) + _above(edges, F.col("right"), y, F.col("top")))
    edge = on_edge(x, y, edges)
    return pairs.where(inside | edge if boundary else inside & ~edge).groupBy(key).agg(F.min(name).alias(name))


def nearest_polygon(points: DataFrame, polygons: DataFrame, key: str, name: str, radius: float, cell: float = CELL) -> DataFrame:
    """(key, name, distance): the nearest polygon within radius degrees of points that lie outside; ties by name."""
    placed = points.select(key, "lon", "lat", F.floor(F.col("lon") / cell).alias("cx"), F.floor(F.col("lat") / cell).alias("cy"))
    pairs = placed.join(in_cells(polygons.select(name, "rings"), radius, cell), ["cx", "cy"])
    near = pairs.select(key, name, edge_distance(F.col("lon"), F.col("lat"), F.col("edges")).alias("distance")).where(F.col("distance") <= radius)
    return near.groupBy(key).agg(F.min(F.struct("distance", name)).alias("best")).select(key, f"best.{name}", "best.distance")


def neighbours(left: DataFrame, right: DataFrame, step: float, on: Sequence[str] = (), reach: float | None = None) -> DataFrame:
    """Pairs of (lon, lat) rows whose grid cells are near: the right side stands in its own cell and those around.

    Right columns are lon2, lat2 and its own. Every pair up to reach (a step, if none is given) apart is among the
    pairs, where a degree of longitude counts as much less than one of latitude as it is shorter.
    """
    reach = step if reach is None else reach
    around = lambda n: F.explode(F.sequence(-n, n))
    high = F.least(F.abs("lat2") + reach, F.lit(89.9))
    steps = F.ceil(F.lit(reach / step) / F.cos(F.radians(high))).cast("long")
    spread = right.withColumnsRenamed({"lon": "lon2", "lat": "lat2"}).withColumn("dx", around(steps)).withColumn("dy", around(F.ceil(F.lit(reach / step)).cast("long")))
    spread = spread.withColumn("cx", F.floor(F.col("lon2") / step) + F.col("dx")).withColumn("cy", F.floor(F.col("lat2") / step) + F.col("dy")).drop("dx", "dy")
    placed = left.withColumn("cx", F.floor(F.col("lon") / step)).withColumn("cy", F.floor(F.col("lat") / step))
    return placed.join(spread, ["cx", "cy", *on]).drop("cx", "cy")
