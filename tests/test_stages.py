"""Stages, sources and sinks on small generated inputs, without a network."""

import io
import json
import random
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.functions import outlines
from waymark.functions.places import read_decisions
from waymark.operators import place_names, python_rules, spatial
from waymark.plans import golden, stage_queries
from waymark.schema import POINT_COLUMNS, RAW_COLUMNS
from waymark.sources import polygons, publishing, references, registry, remote, sinks
from waymark.stages import counts, coverage, deduplication, ingestion, review, tagging
from waymark.streaming import weekly

DATA = "/root/testdata/sf0.001"


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def layer(spark, rows):
    return spark.createDataFrame(rows, "name string, state string, rings array<array<struct<x:double,y:double>>>")


@pytest.fixture(scope="module")
def known(spark):
    return place_names.load_places(spark.createDataFrame(golden.PLACE_ROWS, "state string, name string, source string"), read_decisions(golden.DECISIONS))


def release(folder, rows, stated):
    path = folder / "in.zip"
    lines = [",".join(RAW_COLUMNS)] + [",".join('"' + str(row.get(c, "")).replace('"', '""') + '"' for c in RAW_COLUMNS) for row in rows]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("TXT/ABC_r7.txt", "\n".join(lines) + "\n")
        out.writestr("meta/about.xml", f"<a><gmd:geometricObjectCount> <gco:Integer>{stated}</gco:Integer></gmd:geometricObjectCount></a>")
    return path


def test_ingest_and_tag_every_row(spark, known, tmp_path):
    rows = [{"OID_": str(i), "State": ["KS", "WI", ""][i % 3], "Add_Number": str(i), "St_Name": "MILL ST", "Post_City": "LACROSSE", "Zip_Code": "0" * (i % 5), "Building": 'The "B", Inc.', "NAD_Source": "s"} for i in range(30)]
    manifest = ingestion.ingest(spark, release(tmp_path, rows, 30), tmp_path)
    assert manifest["rows"] == manifest["expected_rows"] == 30 and manifest["release"] == "r7"
    assert json.loads((tmp_path / "r7" / "manifest.json").read_text()) == manifest and ingestion.newest(tmp_path).name == "r7"
    raw = sinks.read_by_state(spark, str(tmp_path / "r7" / "raw"), RAW_COLUMNS)
    assert raw.columns == RAW_COLUMNS and {r.Building for r in raw.select("Building").collect()} == {'The "B", Inc.'}
    points = tagging.tagged_points(raw, known)
    got = {r.nad_oid: r for r in points.collect()}
    assert points.columns == POINT_COLUMNS and len(got) == 30
    assert got["0"].drop_reason == "zero_housenumber" and got["1"].drop_reason is None and got["4"].addr_city == "La Crosse"
    assert all(r.flags == sorted(set(r.flags)) for r in got.values())
    drops = {(r.addr_state, r.outcome): r.n for r in tagging.outcomes(points).collect()}
    assert sum(drops.values()) == 30 and tagging.flag_counts(points).count() > 0
    sinks.write_report(tagging.unknown_cities(points), str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).columns == ["addr_state", "addr_city", "n"]


def test_header_with_quoted_separators(spark, tmp_path):
    from waymark.sources.text_release import read_text

    path = tmp_path / "x.csv"
    path.write_text('"a","b, c"\n1,"two\nlines"\n')
    assert [tuple(r) for r in read_text(spark, str(path), ["a", "b, c"], line_breaks=True).collect()] == [("1", "two\nlines")]


def test_points_in_polygons_with_small_cells(spark):
    shapes = layer(spark, [("in", "A", [square(0.0, 0.0, 4.0), square(1.0, 1.0, 2.0)]), ("next", "A", [square(4.0, 0.0, 3.0)])])
    rows = [(i * 100 + j, 0.05 + i * 0.31, 0.07 + j * 0.29) for i in range(24) for j in range(15)]
    points = spark.createDataFrame(rows, "id int, lon double, lat double")
    want = {}
    for k, x, y in rows:
        if 0 < x < 4 and 0 < y < 4 and not (1 < x < 3 and 1 < y < 3):
            want[k] = "in"
        elif 4 < x < 7 and 0 < y < 3:
            want[k] = "next"
    for most, deepest in ((64, 6), (1, 6), (2, 3), (0, 2)):
        assert {r.id: r.name for r in spatial.points_in_polygons(points, shapes, "id", "name", most=most, deepest=deepest).collect()} == want


def test_a_polygon_of_very_many_corners(spark):
    """No cell holds more than some edges of it, and the points are those of a plain test."""
    rng, n = np.random.default_rng(8), 20_000
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    radius = 2 + 0.3 * np.sin(9 * angle) + 0.02 * rng.random(n)
    ring = np.round(np.column_stack([-97 + radius * np.cos(angle), 38 + radius * np.sin(angle)]), 7)
    ring = [*map(tuple, ring.tolist()), tuple(ring[0].tolist())]
    shapes = layer(spark, [("star", "A", [ring, square(-97.5, 37.5, 1.0)]), ("box", "A", [square(-99.5, 35.5, 0.25)])])
    cells, last = spatial.tree_cells(shapes.select("name", "rings"))
    largest = cells.agg(F.max(F.size("edges"))).first()[0]
    assert 0 < last <= spatial.DEEPEST and (largest <= spatial.MOST_EDGES or last == spatial.DEEPEST and largest < 300)
    at = np.column_stack([rng.uniform(-99.6, -94.4, 3000), rng.uniform(35.4, 40.6, 3000)])
    near = np.array(ring)[rng.integers(0, n, 1000)] + rng.normal(0, 0.002, (1000, 2))
    points = np.concatenate([at, near])
    a, b = np.array(ring[:-1]), np.array(ring[1:])
    crossed = np.array([(((a[:, 1] > y) != (b[:, 1] > y)) & (x < (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / np.where(b[:, 1] == a[:, 1], 1, b[:, 1] - a[:, 1]) + a[:, 0])).sum() % 2 for x, y in points])
    hole = (np.abs(points[:, 0] + 97) < 0.5) & (np.abs(points[:, 1] - 38) < 0.5)
    box = (np.abs(points[:, 0] + 99.375) < 0.125) & (np.abs(points[:, 1] - 35.625) < 0.125)
    want = {k: "box" if box[k] else "star" for k in range(len(points)) if box[k] or crossed[k] and not hole[k]}
    df = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(points)], "id int, lon double, lat double")
    assert {r.id: r.name for r in spatial.points_in_polygons(df, shapes, "id", "name").collect()} == want


def test_neighbours_near_the_pole(spark):
    a = spark.createDataFrame([(1, -150.0, 70.0)], "id int, lon double, lat double")
    b = spark.createDataFrame([(7, -149.0, 70.0)], "other int, lon double, lat double")
    assert spatial.neighbours(a, b, 0.4).count() == 1  # a third of a degree as the crow flies


def test_coverage(spark):
    counties = spark.createDataFrame([("01", "West", "A", [square(0.0, 0.0, 1.0)]), ("02", "East", "A", [square(1.0, 0.0, 1.0)])], "geoid string, name string, state string, rings array<array<struct<x:double,y:double>>>")
    rows = [("own", 0.5, 0.5, None)] * 30 + [("own", 1.5, 0.5, None)] * 10 + [("extra", 1.51, 0.5, None)] * 3 + [("own", 2.03, 0.5, None), ("own", 3.0, 0.5, None), ("own", 0.5, 0.5, "duplicate")]
    bins = coverage.placed_bins(coverage.binned(spark.createDataFrame(rows, "nad_source string, lon double, lat double, drop_reason string")), counties)
    found = coverage.county_counts(bins)
    summary = {r.geoid: (r.points, r.own, r.other, r.origin, [(s.id, s.points) for s in r.sources]) for r in coverage.county_summary(found, ["extra"]).collect()}
    assert summary == {"01": (30, 30, 0, "own", [("own", 30)]), "02": (14, 11, 3, "mixed", [("own", 11), ("extra", 3)])}
    unassigned = found.where("geoid is null").agg(F.sum("points")).first()[0]
    said = json.loads(coverage.coverage_geojson(coverage.county_summary(found, ["extra"]), counties, coverage.source_totals(found), unassigned, "r7"))
    assert said["points"] == 45 and said["unassigned"] == 1 and [f["properties"]["geoid"] for f in said["features"]] == ["01", "02"]
    assert sorted(map(tuple, said["features"][0]["geometry"]["coordinates"][0][0][:-1])) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_common_borders_stay_common():
    zigzag = [(1.0 + 0.001 * (k % 2), k / 20) for k in range(21)]
    left = [(0.0, 0.0), *zigzag, (0.0, 1.0), (0.0, 0.0)]
    right = [*zigzag[::-1], (2.0, 0.0), (2.0, 1.0), zigzag[-1]]
    made = outlines.simplified({"l": [left], "r": [right]}, 0.05, 0.0001)
    border = lambda ring: {p for p in ring if 0.9 < p[0] < 1.1}
    assert border(made["l"][0]) == border(made["r"][0]) and len(made["l"][0]) < 8
    hole = outlines.geometry([square(0.0, 0.0, 9.0), square(2.0, 2.0, 1.0), square(20.0, 0.0, 1.0)])
    assert [len(part) for part in hole["coordinates"]] == [2, 1]


def test_rows_of_one_id_stay(spark):
    point = lambda oid, street, reason, lat=38.0: (oid, -97.5, lat, "1", street, None, "Mesa", "KS", "67001", "Reno", "Site", "2024", [], reason)
    rows = [point("7", "Oak Street", None)] * 3 + [point("8", "Elm Street", "inactive_lifecycle")] * 2 + [point(None, None, "no_street_name")] * 2 + [point("9", "Oak Street", None, 39.0)]
    df = spark.createDataFrame(rows, "nad_oid string, lon double, lat double, addr_housenumber string, addr_street string, addr_unit string, addr_city string, addr_state string, addr_postcode string, county string, placement string, date_update string, flags array<string>, drop_reason string")
    got = sorted((r.nad_oid or "", r.drop_reason or "", ",".join(r.flags)) for r in deduplication.deduplicated(df).collect())
    assert got == [("", "no_street_name", "")] * 2 + [("7", "", "same_address_elsewhere")] + [("7", "duplicate", "")] * 2 + [("8", "inactive_lifecycle", "")] * 2 + [("9", "", "same_address_elsewhere")]


def test_tagging_moves_no_rows(spark, known):
    plan = tagging.tagged_points(spark.createDataFrame([tuple("x" for _ in RAW_COLUMNS)], RAW_COLUMNS), known)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("ArrowEvalPython") >= 1


def test_simplified_shapes_are_those_of_one_place(spark):
    rng = random.Random(3)
    jag = lambda a, b, n: [(a[0] + (b[0] - a[0]) * k / n + (rng.random() - 0.5) * 0.02 * (0 < k < n), a[1] + (b[1] - a[1]) * k / n + (rng.random() - 0.5) * 0.02 * (0 < k < n)) for k in range(n)]
    corner = {(i, j): (i * 1.0, j * 1.0) for i in range(4) for j in range(4)}
    sides = {}
    side = lambda a, b: sides.setdefault((a, b), [*jag(corner[a], corner[b], 15), corner[b]]) if a < b else side(b, a)[::-1]
    shapes = {}
    for i in range(3):
        for j in range(3):
            around = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)]
            ring = [p for a, b in zip(around, around[1:], strict=False) for p in side(a, b)[:-1]]
            shapes[f"{i}{j}"] = [[*ring, ring[0]]]
    hole = [(1.4 + 0.001 * (k % 2), 1.4 + 0.01 * k) for k in range(8)] + [(1.6, 1.5), (1.6, 1.4)]
    island = [*hole[4:], *hole[:4], hole[4]][::-1]
    shapes["11"].append([*hole, hole[0]])
    shapes["in"] = [island]
    shapes["dot"] = [square(9.0, 9.0, 0.00001)]
    df = spark.createDataFrame([(name, rings) for name, rings in shapes.items()], "geoid string, rings array<array<struct<x:double,y:double>>>").repartition(4)
    got = {r.geoid: [[(p.x, p.y) for p in ring] for ring in r.rings] for r in coverage.simplified_shapes(df, 0.05, 0.0001).collect()}
    assert got == {name: rings for name, rings in outlines.simplified(shapes, 0.05, 0.0001).items() if rings}
    assert sum(len(ring) for rings in got.values() for ring in rings) < 0.4 * sum(len(ring) for rings in shapes.values() for ring in rings)


def test_row_groups_outside_are_not_read(spark, tmp_path):
    layer = spark.range(40_000).selectExpr("id", "struct(cast(-120 + id * 7919 % 50000 / 1000.0 as double) as xmin, cast(25 + id * 104729 % 24000 / 1000.0 as double) as ymin) as bbox", "repeat(cast(id as string), 40) as more")
    sinks.write_layer(layer, str(tmp_path / "layer"), 64 << 10)
    box = (F.col("bbox.xmin") >= -100) & (F.col("bbox.xmin") <= -98) & (F.col("bbox.ymin") >= 30) & (F.col("bbox.ymin") <= 32)
    found = spark.read.parquet(str(tmp_path / "layer")).where(box).select("id")
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in layer.where(box).select("id").collect())
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [" in plan.toString() and "bbox.xmin" in plan.toString()
    leaf = plan.collectLeaves().head()
    leaf = leaf.child() if hasattr(leaf, "child") and "FileScan" not in leaf.nodeName() and "Scan" not in leaf.nodeName() else leaf
    read = leaf.metrics().get("numOutputRows").get().value()
    assert 0 < read < 40_000 / 5


def test_history_rules(spark):
    series = lambda day, n, *geoids: spark.createDataFrame([(g, n) for g in geoids], "geoid string, n long")
    empty = spark.createDataFrame([("1", "2024-01-01", 5, "old", "monthly"), ("2", "2024-01-01", 6, "old", "monthly")], "geoid string, day string, n long, source string, interval string")
    once = counts.append_counts(empty, series("x", 7, "1", "2"), "2024-02-01", "new")
    assert sorted(map(tuple, counts.segments(once).collect())) == [("new", "weekly", "2024-02-01", "2024-02-01"), ("old", "monthly", "2024-01-01", "2024-01-01")]
    again = counts.append_counts(once, series("x", 8, "1", "2"), "2024-02-01", "new")
    assert {tuple(r) for r in again.where("day > '2024-01-15'").select("geoid", "n").collect()} == {("1", 8), ("2", 8)} and again.count() == 4
    for day, rows in (("2024-01-15", series("x", 1, "1", "2")), ("2024-01-01", series("x", 1, "1", "2")), ("2024-03-01", series("x", 1, "1")), ("2024-03-01", series("x", 1, "1", "2", "3"))):
        with pytest.raises(ValueError):
            counts.append_counts(again, rows, day, "new")


def test_regions_and_versions(spark):
    far = spark.createDataFrame([("9", [square(10.0, 10.0, 1.0)])], "geoid string, rings array<array<struct<x:double,y:double>>>")
    with pytest.raises(ValueError, match="9"):
        counts.addresses_in_counties(stage_queries._layer(spark, DATA), far)
    versions = iter("aab")
    assert counts.guarded(lambda: next(versions), lambda: 5) == 5
    versions = iter("ab")
    with pytest.raises(RuntimeError):
        counts.guarded(lambda: next(versions), lambda: 5)


def test_request_packing():
    assert counts.batches([("a", 5, 1), ("b", 4, 1), ("c", 9, 1), ("d", 1, 50), ("e", 99, 1)], 10, 50) == [["a", "b"], ["c"], ["d"], ["e"]]
    asked = []

    def ask(names, days):
        asked.append((len(names), len(days)))
        if len(names) * len(days) > 2:
            raise OverflowError
        return {name: [f"{name}{day}" for day in days] for name in names}

    got = counts.fetch_split(["a", "b", "c"], ["1", "2", "3", "4"], ask, OverflowError)
    assert got == {name: [name + day for day in "1234"] for name in "abc"}


def test_triage_and_typos(spark, known):
    points = [(str(i), -97.5 + i * 0.0001, 38.25, str(i), "Oak Street", "Welsford" if i < 6 else "Wellsford", "KS", "67001", "Reno", ["city_not_in_reference"] if i < 6 else [], None) for i in range(20)]
    points += [("90", -90.0, 38.0, "1", "Elm Street", "Nowhere at all", "KS", None, None, ["city_not_in_reference"], None)]
    df = spark.createDataFrame(points, "nad_oid string, lon double, lat double, addr_housenumber string, addr_street string, addr_city string, addr_state string, addr_postcode string, county string, flags array<string>, drop_reason string")
    places = layer(spark, [("Wellsford", "KS", [square(-98.0, 38.0, 1.0)])])
    zips = layer(spark, [("67009", "KS", [square(-91.0, 37.0, 2.0)])]).select("name", "rings")
    triage = {r.city: r for r in review.city_triage(df, places, places.limit(0), zips, known).collect()}
    assert (triage["Welsford"].bucket, triage["Welsford"].suggested, triage["Welsford"].zip_from) == ("correction_place", "Wellsford", "source")
    assert (triage["Nowhere at all"].bucket, triage["Nowhere at all"].top_zip, triage["Nowhere at all"].zip_from) == ("outside_places", "67009", "zcta")
    hamlets = spark.createDataFrame([("KS", "Wellsford", -97.49, 38.26)], "state string, name string, lon double, lat double")
    typos = review.typo_candidates(df, places, hamlets, known).collect()
    assert [(r.city, r.candidate, r.via, r.edits, r.support, r.n) for r in typos] == [("Welsford", "Wellsford", "street", 1, "street+place+zip+gnis", 6)]


def test_typo_query_names_known_places(spark):
    found = {(r.city, r.candidate) for r in stage_queries.typo_candidates(spark, DATA).collect()}
    assert ("Welsford", "Wellsford") in found and all(candidate in ("Wellsford", "Jonah") for _, candidate in found)


def test_unmatched_addresses(spark):
    points, mapped = stage_queries._near_points(spark, DATA)
    only = review.only_mapped(points, mapped)
    assert only.count() > 0 and only.where("street_key = 'elsewhere'").count() > 0


def test_reference_lists(spark, tmp_path):
    (tmp_path / "p.txt").write_text("USPS\tGEOID\tNAME\nKS\t2001\tEast Oak city \nKS\t2002\tPratt CCD\nWI\t5501\tFair Haven CDP\n")
    (tmp_path / "g.txt").write_text('feature_name|feature_class|state_numeric|prim_lat_dec|prim_long_dec\nJonah "J"|Populated Place|20|38.0|-97.0\nOld (historical)|Populated Place|20|38|-97\nMill|Stream|20|1|1\nNowhere|Populated Place|55|0|0\n')
    (tmp_path / "w.csv").write_text('fips,label\n20-01234,"Oak, Kansas"\n2001,Short\n')
    codes = references.state_codes(spark, str(tmp_path / "p.txt"))
    rows = references.all_names(references.read_gazetteer(spark, str(tmp_path / "p.txt"), "census_place"), references.read_hamlets(spark, str(tmp_path / "g.txt"), codes), references.read_labels(spark, str(tmp_path / "w.csv"), codes))
    assert sorted(map(tuple, rows.collect())) == [("KS", "East Oak", "census_place"), ("KS", 'Jonah "J"', "gnis"), ("KS", "Oak", "wikidata"), ("WI", "Fair Haven", "census_place"), ("WI", "Nowhere", "gnis")]
    assert [r.name for r in references.hamlet_points(spark, str(tmp_path / "g.txt"), codes).collect()] == ['Jonah "J"', "Old (historical)"]
    spelled = spark.createDataFrame([("KS", "La Crosse", "gnis"), ("KS", "LaCrosse", "wikidata"), ("KS", "LaCrosse", "census_place")], "state string, name string, source string")
    assert [tuple(r) for r in place_names.conflicts(spelled).collect()] == [("KS", "LaCrosse", "La Crosse (1); LaCrosse (2)")]


def test_source_definitions(tmp_path):
    from waymark.plans.rule_queries import MARKETS

    (tmp_path / "markets.toml").write_text(MARKETS)
    assert [s.id for s in registry.read_sources(tmp_path)] == ["markets"]
    for old, new in (('"cc0"', '"all rights reserved"'), ('quote = "no rights reserved"', 'quote = ""'), ('class = "cc0"', 'class = "osm-waiver"'), ("Add_Number =", "Add_Numbers ="), ('Point_WKT = "place"', "")):
        with pytest.raises(ValueError):
            registry.read_source("x", MARKETS.replace(old, new))
    facts = registry.read_zip_facts({"67001": {"state": "KS", "kind": "single", "city": "Oak"}, "67002": {"state": "KS", "kind": "invalid"}})
    assert registry.single_cities(facts) == [("KS", "67001", "Oak")]
    for bad in ({"6700": {"state": "KS", "kind": "invalid"}}, {"67001": {"state": "KS", "kind": "odd"}}, {"67001": {"state": "KS", "kind": "single"}}, {"67001": {"state": "KS", "kind": "multiple", "cities": ["A"]}}):
        with pytest.raises(ValueError):
            registry.read_zip_facts(bad)


class Answer(io.BytesIO):
    def __init__(self, body, status=200, headers=None):
        super().__init__(body)
        self.status, self.headers = status, headers or {}


def test_downloads_resume_and_check_sizes(tmp_path):
    body = bytes(range(200))
    target = tmp_path / "f.bin"
    (tmp_path / "f.bin.part").write_bytes(body[:50])
    seen = []

    def opener(request, timeout=0):
        seen.append(dict(request.headers))
        return Answer(body[50:], 206)

    assert remote.download("http://u/f", target, 200, opener=opener).read_bytes() == body and seen == [{"Range": "bytes=50-"}]
    assert remote.download("http://u/f", target, 200, opener=None) == target
    other = tmp_path / "g.bin"
    (tmp_path / "g.bin.part").write_bytes(b"zzz")
    assert remote.download("http://u/f", other, 200, opener=lambda *_, **__: Answer(body, 200)).read_bytes() == body
    with pytest.raises(OSError):
        remote.download("http://u/f", tmp_path / "h.bin", 201, opener=lambda *_, **__: Answer(body))


def test_layers_are_read_by_pages(tmp_path):
    rows = {i: {"OID": i, "n": str(i)} for i in (3, 4, 7, 12)}

    def get(url, query=None):
        if not url.endswith("query"):
            return {"maxRecordCount": 4, "objectIdField": "OID"}
        if "outStatistics" in query:
            return {"features": [{"attributes": {"LO": 3.0, "HI": 12.0}}]}
        low, high = (int(x) for x in query["where"].split() if x.isdigit())
        return {"features": [{"attributes": rows[i], "geometry": {"x": i, "y": -i}} for i in sorted(rows) if low <= i <= high]}

    source = registry.Source("s", "KS", "n", "p", registry.Access("arcgis", "http://x/0"), {}, registry.Layout({"Add_Number": "n", "Longitude": "_lon", "Latitude": "_lat"}, "OID"))
    path = remote.fetch_source(source, tmp_path, get)
    assert path.read_text().splitlines() == ["OID,n,_lon,_lat", "3,3,3,-3", "4,4,4,-4", "7,7,7,-7", "12,12,12,-12"]
    tries = []

    def flaky(url, timeout=0):
        tries.append(url)
        return Answer(b'{"error": 1}' if len(tries) < 3 else b'{"ok": 1}')

    assert remote.get_json("u", {"a": 1}, opener=flaky, sleep=lambda s: None) == {"ok": 1} and len(tries) == 3
    with pytest.raises(OSError):
        remote.get_json("u", tries=1, opener=lambda *_, **__: Answer(b'{"error": 1}'))


def test_secrets_are_not_said(tmp_path):
    def post(endpoint, body):
        raise OSError(f"{endpoint} failed")

    with pytest.raises(OSError) as failed:
        remote.first_answer(["http://x?key=secret"], "q", post)
    assert "secret" not in str(failed.value)
    (tmp_path / "keys").write_text("ACCESS_KEY_ID=a\nSECRET_ACCESS_KEY=b\n")
    with pytest.raises(KeyError, match="ENDPOINT"):
        publishing.credentials(tmp_path / "keys", {})
    keys = publishing.credentials(tmp_path / "keys", {"ENDPOINT": "e", "ACCESS_KEY_ID": "z"})
    calls = []
    publishing.publish(tmp_path / "keys", "bucket", "latest", lambda argv, **kw: calls.append((argv, kw["env"])), publishing.upload_environment(keys))
    assert len(calls) == 2 and all("b" not in argv for argv, _ in calls) and calls[0][1]["RCLONE_CONFIG_STORE_ACCESS_KEY_ID"] == "z"
    assert "--no-feature-limit" in publishing.tile_command(["a"], "t", "n", "x")


def test_elements_of_a_map():
    answer = {"elements": [{"lat": 1, "lon": 2, "tags": {"addr:housenumber": "5", "addr:street": "Oak"}}, {"tags": {"highway": "x", "name": "Oak", "alt_name": "Old Oak; Oak"}}, {"center": {"lat": 3, "lon": 4}, "tags": {"addr:housenumber": "6"}}]}
    addresses, roads = remote.map_elements(answer)
    assert [(a["lat"], a["lon"], a["street"]) for a in addresses] == [(1, 2, "Oak"), (3, 4, None)] and roads == [("Oak", False), ("Old Oak", True)]


def test_files_for_others(spark, tmp_path):
    points = spark.createDataFrame([(-97.5, 38.0, "1", "Oak Street", None, "X", "KS", "67001", None, "s"), (0.0, 0.0, "2", None, None, None, "WI", None, "duplicate", "s")], "lon double, lat double, addr_housenumber string, addr_street string, addr_unit string, addr_city string, addr_state string, addr_postcode string, drop_reason string, nad_source string")
    publishing.write_features(points, str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").iterdir() if "=" in p.name] == ["addr_state=KS"]
    assert json.loads(publishing.manifest(points, "r7", zoom=14)) == {"release": "r7", "zoom": 14, "points": 1, "states": {"KS": 1}, "sources": {"s": 1}}
    publishing.write_single(points, str(tmp_path / "one"), "KS")
    assert len(list((tmp_path / "one" / "State=KS").glob("*.parquet"))) == 1
    history = tmp_path / "h.json"
    history.write_text('{"n": 1}')
    sent = []
    publishing.update_history(history, lambda h: {"n": h["n"] + 1}, sent.append)
    assert json.loads(history.read_text()) == {"n": 2} and json.loads((tmp_path / "h.previous.json").read_text()) == {"n": 1} and sent
    with pytest.raises(ZeroDivisionError):
        publishing.update_history(history, lambda h: 1 / 0, sent.append)
    assert len(sent) == 1 and json.loads(history.read_text()) == {"n": 2}


def test_shapefiles(spark, tmp_path):
    def record(number, rings):
        points = [p for ring in rings for p in ring]
        starts = [sum(map(len, rings[:k])) for k in range(len(rings))]
        body = struct.pack("<i4d2i", 5, 0, 0, 9, 9, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points) if rings else struct.pack("<i", 0)
        return struct.pack(">2i", number, len(body) // 2) + body

    shapes = [[square(0.0, 0.0, 4.0), square(1.0, 1.0, 1.0)], [], [square(5.0, 5.0, 1.0)]]
    (tmp_path / "l.shp").write_bytes(bytes(100) + b"".join(record(k, rings) for k, rings in enumerate(shapes)))
    field = lambda name, size: name.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([size]) + bytes(15)
    rows = b"".join(b" " + name.encode("utf-8").ljust(45) + state.encode().ljust(2) for name, state in (("Oak city (balance)", "KS"), ("none", "KS"), ("Elm", "WI")))
    (tmp_path / "l.dbf").write_bytes(bytes([3, 24, 1, 1]) + struct.pack("<IHH", 3, 32 + 64 + 1, 48) + bytes(20) + field("NAME", 45) + field("STUSPS", 2) + b"\r" + rows)
    read = polygons.read_shapefile(spark, str(tmp_path / "l"), ["NAME", "STUSPS"])
    found = polygons.renamed(polygons.layer(read, "NAME", "STUSPS", "STUSPS <> 'XX'"), python_rules.polygon_city)
    assert sorted((r.state, r.name, [[(p.x, p.y) for p in ring] for ring in r.rings]) for r in found.collect()) == [("KS", "Oak", shapes[0]), ("WI", "Elm", shapes[2])]


def test_weekly_stream(spark, tmp_path):
    spark.createDataFrame([("2024-01-0%d 10:00:00" % d, "a") for d in (1, 2, 9)] + [("2024-02-20 10:00:00", "b")], "ts string, kind string").selectExpr("to_timestamp(ts) as ts", "kind").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, kind string").parquet(str(tmp_path / "in"))
    weekly.start(weekly.weekly(stream, "ts", "kind"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    got = {(r.week, r.kind): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("2024-01-01", "a"): 2, ("2024-01-08", "a"): 1}
