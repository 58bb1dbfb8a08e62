"""Spatial joins, duplicates and sources on small hand-made tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from waymark.operators import duplicates, spatial
from waymark.sources import polygons, sinks, text_release

RING = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
NEXT = [(4.0, 0.0), (8.0, 0.0), (6.0, 4.0), (4.0, 0.0)]


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([("a", [RING, HOLE]), ("b", [NEXT])], "name string, rings array<array<struct<x:double,y:double>>>")


def test_containment(spark, shapes):
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 4.0, 0.0), (4, 6.0, 1.0), (5, 9.0, 9.0), (6, 4.0, 2.0)], "id int, lon double, lat double")
    inside = {r.id: r.name for r in spatial.points_in_polygons(points, shapes, "id", "name").collect()}
    assert inside == {1: "a", 4: "b"}
    touching = {r.id: r.name for r in spatial.points_in_polygons(points, shapes, "id", "name", boundary=True).collect()}
    assert touching == {1: "a", 3: "a", 4: "b", 6: "a"}


def test_nearest(spark, shapes):
    points = spark.createDataFrame([(1, -0.5, 2.0), (2, 8.3, -0.4), (3, 20.0, 20.0)], "id int, lon double, lat double")
    got = {r.id: (r.name, round(r.distance, 6)) for r in spatial.nearest_polygon(points, shapes, "id", "name", 1.0).collect()}
    assert got == {1: ("a", 0.5), 2: ("b", 0.5)}


def test_far_copies_stay_and_verdicts_do_not_depend_on_order(spark):
    rows = [(1, "k", 40.0, -86.0, 1, "x"), (2, "k", 40.0, -86.0001, 2, "x"), (3, "k", 40.01, -86.0, 3, "y"), (4, "k", 40.01, -86.0, 4, "y"), (5, "k", 40.01, -86.0, 5, "z"), (6, "j", 40.0, -86.0, 1, None)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id int, key string, lat double, lon double, rank int, city string").repartition(3)
        got = {r.id: (r.is_duplicate, r.elsewhere) for r in duplicates.verdicts(df, ["key"], ["key", "city"], [F.asc("rank")]).collect()}
        assert got == {1: (False, True), 2: (True, False), 3: (False, True), 4: (True, False), 5: (False, True), 6: (False, False)}


def test_copies_of_a_common_key(spark):
    rows = [(i, b"k" if i % 3 else None if i % 2 else bytes([i % 251])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, h binary").repartition(7)
    firsts = {}
    for i, h in rows:
        firsts.setdefault(h, i)
    for pieces in (1, 32):
        assert {r.id: r.is_duplicate for r in duplicates.after_first(df, "h", "id", pieces).collect()} == {i: firsts[h] != i for i, h in rows}
    assert duplicates.after_first(df.where("false"), "h", "id").collect() == []


def test_strict_header_and_text_values(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_text('id,zip,name\n1,02559,"A, ""B"""\n2,,\n')
    assert [tuple(r) for r in text_release.read_text(spark, str(path), ["id", "zip", "name"]).collect()] == [("1", "02559", 'A, "B"'), ("2", None, None)]
    for columns in (["id", "name", "zip"], ["id", "zip"], ["id", "zip", "name", "more"]):
        with pytest.raises(ValueError):
            text_release.read_text(spark, str(path), columns)


def test_geojson_round_trip(spark, tmp_path):
    layer = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"NAME": "a", "ST": "IN"}, "geometry": {"type": "Polygon", "coordinates": [RING, HOLE]}}, {"type": "Feature", "properties": {"NAME": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [[RING], [NEXT]]}}]}
    path = tmp_path / "layer.json"
    path.write_text(json.dumps(layer, indent=1))
    got = {r.NAME: (r.ST, [[(p.x, p.y) for p in ring] for ring in r.rings]) for r in polygons.read_geojson(spark, str(path), ["NAME", "ST"]).collect()}
    assert got == {"a": ("IN", [RING, HOLE]), "b": (None, [RING, NEXT])}
    points = spark.createDataFrame([(-86.0, 40.0, "1", "Oak Street", None, "X", "IN", "47201", None), (0.0, 0.0, "2", None, None, None, "IN", None, "duplicate")], "lon double, lat double, addr_housenumber string, addr_street string, addr_unit string, addr_city string, addr_state string, addr_postcode string, drop_reason string")
    lines = [json.loads(r.value) for r in sinks.geojson_lines(points).collect()]
    assert lines == [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [-86.0, 40.0]}, "properties": {"addr:housenumber": "1", "addr:street": "Oak Street", "addr:city": "X", "addr:state": "IN", "addr:postcode": "47201"}}]
    sinks.write_by_state(points, str(tmp_path / "out"))
    assert sinks.read_by_state(spark, str(tmp_path / "out"), ["addr_housenumber", "addr_state"]).count() == 2
