"""Tiles, quoted text in splits, and paged layers."""

import http.server
import json
import math
import random
import threading
import urllib.parse
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waymark.functions import tiles as T
from waymark.sources import layer_source, quoted_text, text_release, tile_archive

POINT = "lon double, lat double, addr_housenumber string, addr_street string, addr_unit string, addr_city string, addr_state string, addr_postcode string, drop_reason string, k long"


def units(lon, lat, zoom):
    size = 2**zoom * T.EXTENT
    lat = max(-T.MOST_LATITUDE, min(T.MOST_LATITUDE, lat))
    whole = lambda v: max(0, min(size - 1, math.floor(v)))
    return whole((lon + 180) / 360 * size), whole((0.5 - math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) / (2 * math.pi)) * size)


def test_tile_numbers(spark):
    places = [(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0), (2, 0, 0), (2, 1, 3)] + [(z, x, y) for z in (3, 4) for x in range(2**z) for y in range(2**z)] + [(14, 16383, 5), (14, 0, 16383)]
    got = spark.createDataFrame(places, "zoom int, x long, y long").withColumn("n", T.tile_number("zoom", "x", "y")).collect()
    assert [r.n for r in got[:6]] == [0, 1, 2, 3, 4, 5]
    assert all(T.numbered_tile(r.n) == (r.zoom, r.x, r.y) for r in got)
    curve = sorted((r.n, r.x, r.y) for r in got if r.zoom == 4)
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(curve, curve[1:], strict=False))


def test_directories():
    entries = [(5, 0, 10, 1), (6, 10, 7, 3), (40, 500, 9, 1), (41, 509, 2, 0)]
    assert T.entries_of(T.directory(entries)) == entries and T.entries_of(T.directory([])) == []
    assert [T.entry_of(entries, n) for n in (4, 5, 8, 9, 40, 99)] == [None, entries[0], entries[1], None, entries[2], entries[3]]


@pytest.fixture(scope="module")
def town(spark):
    rng = random.Random(4)
    rows = [(-97.5 + rng.random() * 0.2, 38.0 + rng.random() * 0.2, str(k), f"Straße {k % 50}", "Apt 1" if k % 7 == 0 else " " if k % 7 == 1 else None, "Reno", "KS", None, "duplicate" if k % 50 == 0 else None, k) for k in range(3000)]
    rows += [(-97.4, 38.1, str(k), "Tower Road", str(k), None, "KS", "67001", None, k) for k in range(5000, 7000)]  # one dense tile
    rows += [(180.0, 89.9, "1", "Pole", None, None, "AK", None, None, 9001), (-180.0, -90.0, "2", "Pole", None, None, "AK", None, None, 9002), (None, 1.0, "3", "x", None, None, "AK", None, None, 9003), (float("nan"), 1.0, "4", "x", None, None, "AK", None, None, 9004)]
    return rows, spark.createDataFrame(rows, POINT).repartition(5)


def test_archive(spark, town, tmp_path, monkeypatch):
    rows, points = town
    monkeypatch.setattr(tile_archive, "LEAF", 50)
    target = f"{tmp_path}/made/points.pmtiles"
    sidecar = tile_archive.write_archive(points, target, F.col("k"), 10, 14, metadata={"name": "Reno"})
    kept = [r for r in rows if r[8] is None and r[0] is not None and r[0] == r[0]]
    assert sidecar["points"] == len(kept) and sidecar["file"] == "points.pmtiles" and sidecar["bytes"] == (tmp_path / "made" / "points.pmtiles").stat().st_size
    archive = tile_archive.Archive(f"file://{target}")
    assert archive.root[0][3] == 0 and (archive.header["least"], archive.header["most"]) == (10, 14) and archive.metadata()["name"] == "Reno"
    want: Counter = Counter()
    for zoom in range(10, 15):
        best = {}
        for r in sorted(kept, key=lambda r: r[9]):
            x, y = (v >> 14 - zoom for v in units(r[0], r[1], 14))
            best.setdefault((x // tile_archive.THIN, y // tile_archive.THIN) if zoom < 14 else r[9], (r, x, y))
        tags = lambda r: tuple(sorted((name, value) for name, value in zip(("addr:housenumber", "addr:street", "addr:unit", "addr:city", "addr:state", "addr:postcode"), r[2:8], strict=True) if value and value.strip()))
        want.update((zoom, x // 4096, y // 4096, x % 4096, y % 4096, tags(r)) for r, x, y in best.values())
    got = Counter((r.zoom, r.tile_x, r.tile_y, r.x, r.y, tuple(sorted(r.properties.items()))) for r in tile_archive.read_archive(spark, f"file://{target}").collect())
    assert got == want
    number = spark.createDataFrame([(14, *(v // 4096 for v in units(-97.4, 38.1, 14)))], "zoom int, x long, y long").select(T.tile_number("zoom", "x", "y")).first()[0]
    assert len(list(T.tile_points(archive.tile(number)))) >= 2000 and archive.tile(3) is None


def test_archive_with_few_tiles_and_none(spark, town, tmp_path):
    _, points = town
    few = tile_archive.write_archive(points.where("k < 20"), f"{tmp_path}/few.pmtiles")
    assert few["points"] == 19 and tile_archive.read_archive(spark, f"{tmp_path}/few.pmtiles").where("zoom = 14").count() == 19
    none = tile_archive.write_archive(points.where("false"), f"{tmp_path}/none.pmtiles")
    assert none["points"] == 0 and tile_archive.read_archive(spark, f"{tmp_path}/none.pmtiles").count() == 0


def odd_file(rng, n):
    values = ["", "plain", '"quoted"', '"a ""b"" c"', '"two\nlines"', '"\n\n"', '"x,\n""y"",z\n"', '5" pipe', 'a"b"c', '"after" it', ' "spaced"', '""', '","', "é", '"end\r\nof"']
    rows = [",".join(rng.choice(values) for _ in range(3)) for _ in range(n)]
    end = rng.choice(["\n", "\r\n"])
    return f"a,b,c{end}" + "".join(row + end + rng.choice(["", "", "", end]) for row in rows)


@pytest.mark.parametrize(("seed", "size"), [(0, 7), (1, 64), (2, 64), (3, 300), (4, 1000), (5, 19)])
def test_any_split_gives_the_rows_of_one_task(spark, tmp_path, seed, size):
    rng = random.Random(seed)
    for k in range(2):
        (tmp_path / f"{k}.csv").write_bytes(odd_file(rng, 60).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    plain = lambda rows: Counter(tuple(v and v.replace("\r\n", "\n") for v in row) for row in rows.collect())  # one task makes line ends within values alike
    whole = plain(text_release.read_text(spark, str(tmp_path), ["a", "b", "c"], line_breaks=True, splits=False))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = plain(text_release.read_text(spark, str(tmp_path), ["a", "b", "c"], line_breaks=True))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == whole, (list((got - whole).items())[:4], list((whole - got).items())[:4])


def test_states_by_join_and_an_open_end(spark, tmp_path, monkeypatch):
    text = "a,b\n" + "".join(f'{k},"line\nbreak {k}"\n' for k in range(50)) + '51,"never\ncloses\n'
    (tmp_path / "x.csv").write_text(text)
    want = {(str(k), f"line\nbreak {k}") for k in range(50)} | {("51", "never\ncloses")}
    monkeypatch.setattr(quoted_text, "MOST_OPEN", 0)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50")
        got = {(r.a, r.b.rstrip("\n")) for r in text_release.read_text(spark, str(tmp_path), ["a", "b"], line_breaks=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want


def test_every_file_has_its_header_checked(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    for line_breaks in (True, False):
        with pytest.raises(ValueError, match="reordered"):
            text_release.read_text(spark, str(tmp_path), ["a", "b"], line_breaks=line_breaks)
    (tmp_path / "2.csv").write_text("a,b\n2,1\n")
    for line_breaks in (True, False):
        assert sorted(map(tuple, text_release.read_text(spark, str(tmp_path), ["a", "b"], line_breaks=line_breaks).collect())) == [("1", "2"), ("2", "1")]


ROWS = {i: {"OID": i, "name": None if i % 5 == 0 else f"n'{i % 3}", "num": i * 2} for i in range(3, 400) if i % 7}


class Layer(http.server.BaseHTTPRequestHandler):
    """A layer of ROWS of which some requests fail; conditions are read with a few patterns."""

    def do_GET(self):
        server = self.server
        where, query = urllib.parse.urlparse(self.path), {}
        query = dict(urllib.parse.parse_qsl(where.query))
        with server.lock:
            server.asked.append(query.get("where"))
            fails = where.path.endswith("query") and server.rng.random() < server.failing
        if fails:
            answer = {"error": {"code": 500}}
        elif not where.path.endswith("query"):
            answer = {"maxRecordCount": 50, "objectIdField": "OID", "fields": [{"name": "OID", "type": "esriFieldTypeOID"}, {"name": "name", "type": "esriFieldTypeString"}, {"name": "num", "type": "esriFieldTypeInteger"}]}
        elif "outStatistics" in query:
            answer = {"features": [{"attributes": {"lo": min(ROWS), "hi": max(ROWS)}}]}
        else:
            low, high = (int(x) for x in query["where"].split(" AND (")[0].split()[2::2])
            rows = [r for i, r in ROWS.items() if low <= i <= high]
            if "name IS NOT NULL" in query["where"]:
                rows = [r for r in rows if r["name"] is not None]
            if "name IN ('n''1')" in query["where"]:
                rows = [r for r in rows if r["name"] == "n'1"]
            answer = {"features": [{"attributes": r, "geometry": {"x": r["OID"], "y": -r["OID"]} if r["OID"] % 11 else None} for r in rows]}
        body = json.dumps(answer).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


@pytest.fixture
def layer():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Layer)
    server.asked, server.rng, server.failing, server.lock = [], random.Random(1), 0.0, threading.Lock()
    thread = threading.Thread(target=server.serve_forever, daemon=True)
    thread.start()
    yield server
    server.shutdown()


def test_layer_pages_are_partitions(spark, layer):
    layer.failing = 0.3
    url = f"http://127.0.0.1:{layer.server_port}/layer/0"
    rows = layer_source.read_layer(spark, url, ["OID", "name", "num"], wait=0, tries=12)
    assert rows.rdd.getNumPartitions() == 8
    want = sorted((str(i), r["name"], str(r["num"]), float(i) if i % 11 else None) for i, r in ROWS.items())
    assert sorted((r.OID, r.name, r.num, r._lon) for r in rows.collect()) == want
    layer.failing = 0.0
    layer.asked.clear()
    assert {r.OID for r in rows.where("name = \"n'1\"").collect()} == {str(i) for i, r in ROWS.items() if r["name"] == "n'1"}
    assert any("name IN ('n''1')" in (asked or "") for asked in layer.asked)


def test_communities_lack_nothing(spark, layer):
    url = f"http://127.0.0.1:{layer.server_port}/layer/0"
    got = {r.number for r in layer_source.read_communities(spark, url, "KS", "num", "name", wait=0).collect()}
    assert got == {str(r["num"]) for i, r in ROWS.items() if r["name"] and i % 11}
