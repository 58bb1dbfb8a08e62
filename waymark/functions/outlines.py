"""Simpler outlines of neighbouring polygons whose common borders stay common.

A border is simplified from its own points alone, in a direction that both sides agree on, so rings can be made one by
one, given the junctions on them: see stages/coverage.py for the same over tasks.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

Point = tuple[float, float]
Ring = list[Point]


def _steps(rings: list[Ring]) -> Iterator[tuple[Point, Point]]:
    for ring in rings:
        yield from zip(ring[:-1], ring[1:], strict=True)


def _junctions(shapes: dict[str, list[Ring]]) -> set[Point]:
    """Points where borders meet or end: the shapes on the borders beside them are not the same on both sides."""
    sides: dict[tuple[Point, Point], set[str]] = defaultdict(set)
    at: dict[Point, set[tuple[Point, Point]]] = defaultdict(set)
    for name, rings in shapes.items():
        for a, b in _steps(rings):
            border = (min(a, b), max(a, b))
            sides[border].add(name)
            at[a].add(border)
            at[b].add(border)
    return {point for point, borders in at.items() if len(borders) != 2 or len({frozenset(sides[b]) for b in borders}) != 1}


def _arcs(ring: Ring, junctions: set[Point]) -> list[Ring]:
    """The ring cut at junctions; one without is cut at its two extreme points, so that both sides cut alike."""
    points = ring[:-1]
    cuts = [k for k, point in enumerate(points) if point in junctions]
    if len(cuts) < 2:
        cuts = sorted({*cuts, points.index(min(points)), points.index(max(points))})
    turned = points[cuts[0] :] + points[: cuts[0]]
    places = [k - cuts[0] for k in cuts] + [len(points)]
    return [[*turned, turned[0]][a : b + 1] for a, b in zip(places[:-1], places[1:], strict=True)]


def _area(a: Point, b: Point, c: Point) -> float:
    return abs((b[0] - a[0]) * (c[1] - a[1]) - (c[0] - a[0]) * (b[1] - a[1])) / 2


def simpler(arc: Ring, least: float) -> Ring:
    """The arc without the points whose triangle with their neighbours is smaller than least, smallest first; ends stay."""
    before, after = {k: k - 1 for k in range(len(arc))}, {k: k + 1 for k in range(len(arc))}
    size = {k: _area(*arc[k - 1 : k + 2]) for k in range(1, len(arc) - 1)}
    heap = [(area, k) for k, area in size.items()]
    heapq.heapify(heap)
    while heap:
        area, k = heapq.heappop(heap)
        if size.get(k) != area:
            continue
        if area >= least:
            break
        del size[k]
        a, b = before[k], after[k]
        after[a], before[b] = b, a
        for n in (a, b):
            if n in size:
                size[n] = max(area, _area(arc[before[n]], arc[n], arc[after[n]]))
                heapq.heappush(heap, (size[n], n))
    return [point for k, point in enumerate(arc) if k in size or k in (0, len(arc) - 1)]


def simpler_ring(ring: Ring, junctions: set[Point], tolerance: float, grid: float) -> Ring | None:
    """The ring with each border between junctions simplified, on a grid of points; None if it vanishes."""
    digits = max(0, round(-math.log10(grid)))

    def border(arc: Ring) -> Ring:
        forward = arc if (arc[0], arc[1]) <= (arc[-1], arc[-2]) else arc[::-1]
        made = [(round(x, digits), round(y, digits)) for x, y in simpler(forward, tolerance * tolerance)]
        return made if forward is arc else made[::-1]

    joined = [p for arc in _arcs(ring, junctions) for p in border(arc)[:-1]]
    joined = [p for k, p in enumerate(joined) if p != joined[k - 1]]
    return [*joined, joined[0]] if len(joined) > 2 else None


def simplified(shapes: dict[str, list[Ring]], tolerance: float, grid: float) -> dict[str, list[Ring]]:
    """The shapes with each border simplified once, for a few of them; rings that vanish are left out."""
    junctions = _junctions(shapes)
    return {name: [made for ring in rings if (made := simpler_ring(ring, junctions, tolerance, grid))] for name, rings in shapes.items()}


def ring_area(ring: Ring) -> float:
    """Positive for rings that run against the clock."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in _steps([ring])) / 2


def inside(point: Point, ring: Ring) -> bool:
    x, y = point
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in _steps([ring])) % 2 == 1


def geometry(rings: list[Ring]) -> dict:
    """A GeoJSON MultiPolygon: each ring that lies in an odd number of others is a hole of the smallest around it."""
    depth = [[k for k, other in enumerate(rings) if other is not ring and inside(ring[0], other)] for ring in rings]
    outer = {k: [rings[k]] for k, around in enumerate(depth) if len(around) % 2 == 0}
    for k, around in enumerate(depth):
        if len(around) % 2:
            holder = min((j for j in around if j in outer), key=lambda j: abs(ring_area(rings[j])))
            outer[holder].append(rings[k])
    return {"type": "MultiPolygon", "coordinates": [[[list(p) for p in ring] for ring in part] for part in outer.values()]}
