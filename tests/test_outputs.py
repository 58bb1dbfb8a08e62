"""Written outputs, kept answers, the versioned history, viewer figures and closest names."""

import difflib
import io
import json
import random
import urllib.error

import pytest
from pyspark.sql import functions as F

from waymark.functions import viewer
from waymark.operators.closest import closest_names
from waymark.plans import output_queries
from waymark.plans.rule_queries import MARKETS
from waymark.schema import RAW_COLUMNS
from waymark.sources import ledger, registry, remote, tile_archive
from waymark.stages import counts, outputs, review
from waymark.streaming import upsert

DATA = "/root/testdata/sf0.001"


def expected(street, names, cutoff=0.75):
    return next(iter(difflib.get_close_matches(street, names, 1, cutoff)), None)


@pytest.mark.parametrize("cutoff", [0.7, 0.75, 0.9])
def test_closest_names_lose_no_pair(spark, cutoff):
    rng = random.Random(int(cutoff * 100))
    names = {"".join(rng.choice("abcde") for _ in range(rng.randrange(1, 22))) for _ in range(120)} | {"Oak Street", "Elm Street", "aaaa", "aaaaaaaa", "é"}
    streets = set()
    for name in names:
        letters = list(name)
        for _ in range(rng.randrange(0, 4)):
            letters.insert(rng.randrange(len(letters) + 1), rng.choice("abcxyz"))
            if len(letters) > 2:
                letters.pop(rng.randrange(len(letters)))
        streets.add("".join(letters))
    streets |= {"Okk Street", "Zz", "aaa"}
    got = {r.street: r.closest for r in closest_names(spark.createDataFrame([(s,) for s in streets] * 2, "street string"), spark.createDataFrame([(n,) for n in names] + [(None,), ("",)], "name string"), cutoff).collect()}
    assert got == {street: expected(street, sorted(names), cutoff) for street in streets}


def test_closest_street_query(spark):
    names = sorted({r.p_name for r in spark.read.parquet(f"{DATA}/part.parquet").select("p_name").collect()})
    got = output_queries.closest_streets(spark, DATA).collect()
    assert len(got) > 20 and all(r.closest == expected(r.street, names) for r in got)


def test_figures(spark):
    values = [0.04, 1.44, 1.96, 8.2, 34.6, 264, 4149, 9999]
    assert [r.v for r in spark.createDataFrame([(float(v),) for v in values], "x double").select(viewer.rough(F.col("x")).alias("v")).collect()] == [0.0, 1.4, 2.0, 8, 35, 260, 4100, 10000]
    units = ["10A", "2", "Apt 3", "10", "2b", "002", None, "a10", "a9"]
    assert [r.u for r in spark.createDataFrame([(u,) for u in units], "u string").orderBy(viewer.natural_key(F.col("u")), "u").collect()] == [None, "002", "2", "2b", "10", "10A", "a9", "a10", "Apt 3"]
    rings = [("al", 172.0, 179.0), ("al", -179.0, -130.0), ("ks", -102.0, -94.0), ("all", -180.0, 10.0), ("all", 0.0, 180.0), ("one", 5.0, 5.0)]
    got = {r.g: (r.west, r.east) for r in viewer.least_extents(spark.createDataFrame(rings, "g string, west double, east double"), ["g"]).collect()}
    assert got == {"al": (172.0, 230.0), "ks": (-102.0, -94.0), "all": (-180.0, 180.0), "one": (5.0, 5.0)}


def test_ledger_asks_only_for_what_is_missing(spark, tmp_path):
    log, broken = tmp_path / "log", tmp_path / "broken"
    log.mkdir()
    broken.touch()
    where, flag = str(log), str(broken)

    def ask(body):
        import os
        import uuid

        if body == "b7" and os.path.exists(flag):
            raise OSError("the service is down")
        open(f"{where}/{body}-{uuid.uuid4().hex}", "w").close()
        return body.upper()

    requests = spark.createDataFrame([(f"k{i}", f"b{i % 12}") for i in range(30)], "key string, body string")
    with pytest.raises(Exception, match="down"):
        ledger.answered(requests, str(tmp_path / "answers"), ask)
    before = len(list(log.iterdir()))
    assert 0 < before < 12 or before == 11
    broken.unlink()
    got = {r.key: r.answer for r in ledger.answered(requests, str(tmp_path / "answers"), ask).collect()}
    assert got == {f"k{i}": f"B{i % 12}" for i in range(30)}
    assert len(list(log.iterdir())) == 12


def test_history_service():
    tries, waits = [], []

    def opener(request, timeout=0):
        tries.append(request.data.decode())
        if len(tries) == 1:
            raise urllib.error.HTTPError("u", 429, "busy", {}, None)
        if len(tries) == 2:
            raise TimeoutError
        return io.BytesIO(b'{"groupByResult": []}')

    fields = remote.history_fields([{"type": "Feature", "properties": {"id": "1"}}], ["2024-01-01"], "x=*")
    assert remote.post_form("http://u", fields, opener=opener, sleep=waits.append) == {"groupByResult": []}
    assert len(tries) == 3 and waits == [60.0, 120.0] and "time=2024-01-01" in tries[0]
    with pytest.raises(urllib.error.HTTPError):
        remote.post_form("http://u", fields, opener=lambda *_, **__: (_ for _ in ()).throw(urllib.error.HTTPError("u", 413, "large", {}, None)), sleep=waits.append)
    assert len(waits) == 2
    answer = {"groupByResult": [{"groupByObject": g, "result": [{"timestamp": f"{day}T00:00:00Z", "value": v + 0.4} for day, v in (("2024-01-01", 3), ("2024-02-01", 4))]} for g in ("2", "1")]}
    assert remote.history_series(answer, ["1", "2"], ["2024-01-01", "2024-02-01"]) == {"1": [3, 4], "2": [3, 4]}
    for names, days in ((["1"], ["2024-01-01", "2024-02-01"]), (["1", "2"], ["2024-01-01"])):
        with pytest.raises(ValueError):
            remote.history_series(answer, names, days)


def test_documents(spark):
    found = spark.createDataFrame([("02", 5), ("01", 7)], "geoid string, n long")
    said = json.loads(counts.counts_document(found, None, "http://x", {"etag": "e", "published": "2024-01-02"}, "2024-01-03", "layer", "all").first()[0])
    assert said == {"source": "layer", "url": "http://x", "etag": "e", "published": "2024-01-02", "newest_edit": None, "built": "2024-01-03", "attribution": "all", "addresses": 12, "counties": {"01": 7, "02": 5}}
    rows = [(g, day, n, source, "monthly" if source == "service" else "weekly") for g, ns in (("02", (1, 2, 3)), ("01", (4, 5, 6))) for day, n, source in zip(("2024-01-01", "2024-02-01", "2024-02-08"), ns, ("service", "service", "layer"), strict=True)]
    said = json.loads(counts.history_document(spark.createDataFrame(rows, upsert.SERIES), "x=*", {"service": "http://s"}, "2024-03-01", "all").first()[0])
    assert said["dates"] == ["2024-01-01", "2024-02-01", "2024-02-08"] and said["counties"] == {"01": [4, 5, 6], "02": [1, 2, 3]}
    assert said["segments"] == [{"source": "service", "url": "http://s", "interval": "monthly", "from": "2024-01-01", "to": "2024-02-01"}, {"source": "layer", "interval": "weekly", "from": "2024-02-08", "to": "2024-02-08"}]


def test_stream_keeps_a_history(spark, tmp_path):
    schema = upsert.SERIES
    day = lambda day, a, b, source="layer", *more: [("1", day, a, source, "weekly"), ("2", day, b, source, "weekly"), *more]
    source, table = tmp_path / "in", upsert.VersionedSeries(spark, str(tmp_path / "table"))

    def arrives(number, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        upsert.start(stream, str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination(120)

    content = lambda: sorted((r.geoid, r.day, r.n) for r in table.read().collect())
    arrives(0, day("2024-01-01", 1, 2))
    arrives(1, day("2024-01-08", 3, 4))
    assert content() == [("1", "2024-01-01", 1), ("1", "2024-01-08", 3), ("2", "2024-01-01", 2), ("2", "2024-01-08", 4)]
    arrives(2, day("2024-01-08", 5, 6))
    latest = [("1", "2024-01-01", 1), ("1", "2024-01-08", 5), ("2", "2024-01-01", 2), ("2", "2024-01-08", 6)]
    assert content() == latest
    pointer = table.pointer()
    table.upsert(spark.createDataFrame(day("2024-01-08", 9, 9), schema), pointer["batch"])  # a batch that comes again
    assert content() == latest and table.pointer() == pointer
    refused = [day("2024-01-02", 1, 1), [("1", "2024-01-15", 1, "layer", "weekly")], day("2024-01-15", 1, 1, "layer", ("3", "2024-01-15", 1, "layer", "weekly")), day("2024-01-08", 1, 1, "other"), [*day("2024-01-15", 1, 1), ("1", "2024-01-15", 1, "other", "weekly")]]
    for rows in refused:
        with pytest.raises(ValueError):
            table.upsert(spark.createDataFrame(rows, schema), pointer["batch"] + 1)
        assert content() == latest and table.pointer() == pointer


def test_written_stages(spark, tmp_path):
    rows = [{"State": "KS", "NAD_Source": "s", "County": "Reno", "St_Name": ["OAK", "Old Mill", "ELM ST"][i % 3], "St_PosTyp": "St" if i % 2 else " ", "Add_Number": str(i % 4), "Longitude": str(-97 - i % 5), "Latitude": "38", "UUID": str(i // 2), "Zip_Code": "67001"} for i in range(12)] + [{"State": None, "NAD_Source": None}]
    raw = spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    outputs.write_profile(raw, str(tmp_path / "profile"), tokens=4)
    report = lambda name: [r.asDict() for r in spark.read.option("header", True).csv(str(tmp_path / "profile" / name)).collect()]
    fine = next(r for r in report("quality") if r["State"] == "KS")
    assert (fine["n_rows"], fine["street_name_all_caps"], fine["zero_number"], fine["shared_coords"], fine["repeated_uuid"], fine["min_lon"]) == ("12", "8", "3", "7", "6", "-101.0")
    assert len(report("fill_rates")) == 2 and next(r for r in report("fill_rates") if r["State"] == "KS")["counties"] == "1"
    assert [(r["col"], r["val"], r["n"], r["sources"], r["states"]) for r in report("street_parts")] == [("St_PosTyp", "St", "6", "1", "1")]
    assert {(r["position"], r["token"], r["n"]) for r in report("street_name_tokens")} == {("first", "OAK", "4"), ("first", "OLD", "4"), ("first", "ELM", "4"), ("last", "MILL", "4"), ("last", "ST", "4")}
    assert report("top_values")
    outputs.write_references(spark.createDataFrame([("KS", "La Crosse", "gnis"), ("KS", "LaCrosse", "wikidata"), ("KS", "LaCrosse", "wikidata")], "state string, name string, source string"), str(tmp_path / "refs"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "refs" / "place_name_conflicts")).collect()] == [("KS", "La Crosse", "La Crosse (1); LaCrosse (1)")]
    source = registry.read_source("markets", MARKETS)
    given = spark.createDataFrame([("1", "5", "Oak", "St", "POINT (-97 38)"), (None, "6", "Elm", None, "POINT EMPTY")], "rid string, number string, kind string, `street name` string, place string")
    made = outputs.build_sources(spark, [source], str(tmp_path / "extra"), lambda s: given)
    assert [(m["id"], m["rows"]) for m in made] == [("markets", 1)] and outputs.build_sources(spark, [source], "x", None, only=["other"]) == []


def test_export(spark, tmp_path):
    points = spark.createDataFrame([(-97.5 - k / 1000, 38.0, str(k), "Oak Street", None, "X", "KS", "67001", "duplicate" if k == 3 else None, "s") for k in range(9)], "lon double, lat double, addr_housenumber string, addr_street string, addr_unit string, addr_city string, addr_state string, addr_postcode string, drop_reason string, nad_source string")
    sidecar = outputs.export(points, str(tmp_path), "r7", "points", "a publisher", "2024-01-01")
    assert json.loads((tmp_path / "points-r7.json").read_text()) == sidecar and sidecar["points"] == 8 and sidecar["release"] == "r7"
    assert tile_archive.Archive(f"file://{tmp_path}/points-r7.pmtiles").metadata()["attribution"] == "a publisher"
    assert spark.read.text(str(tmp_path / "geojson")).count() == 8


def test_spot_check(spark):
    points = spark.createDataFrame([(k, str(k), "Oak Street" if k < 4 else "Ok Lane", None if k == 1 else "X", "67001", "Apt 1" if k % 2 else "", "s", -97.5, 38.0 + k / 1000) for k in range(1, 7)], "id int, housenumber string, street string, city string, postcode string, unit string, source string, lon double, lat double")
    mapped = spark.createDataFrame([("1", "Oak Street", "X", "67001", -97.5, 38.001), ("2", "Elm Street", "X", "67001", -97.5, 38.002), ("9", "Elm Street", "X", None, -97.5, 38.5)], "housenumber string, street string, city string, postcode string, lon double, lat double")
    said = review.spot_check(points, mapped, spark.createDataFrame([("Oak Street", False), ("Oak Lane", False), ("Old Oak", True)], "name string, alternate boolean"))
    assert (said["source_points"], said["no_city"], said["units"], said["osm_addresses"], said["osm_street_names"]) == (6, 1, [("Apt 1", 3)], 3, 2)
    assert said["addresses"]["matched"] == 1 and said["addresses"]["street_conflict"] == 1 and said["addresses"]["not_in_osm"] == 4 and said["addresses"]["osm_only"] == 2
    assert said["streets"]["exact"] == (1, 3) and said["closest"] == [("Ok Lane", "Oak Lane")]
