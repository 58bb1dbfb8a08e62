"""Stages that write what others read: profile reports, reference lists, the rows of declared sources, and the published files."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.columns import whole_number
from waymark.operators import place_names, profiling
from waymark.schema import RAW_COLUMNS
from waymark.sources import publishing, sinks
from waymark.sources.registry import Source, raw_rows
from waymark.sources.tile_archive import write_archive
from waymark.stages.tagging import degrees

GROUP = ("State", "NAD_Source")
STREET_PARTS = tuple("St_PreMod St_PreDir St_PreTyp St_PreSep St_PosTyp St_PosDir St_PosMod".split())
#: Columns of a small number of values, which are listed by frequency.
VALUES = ("AddNum_Pre", "AddNum_Suf", *STREET_PARTS, *"Building Floor Unit Inc_Muni Post_City Census_Plc Uninc_Comm PlaceNmTyp AddrRefSys Placement RelateType ParcelSrc AddrClass Lifecycle AnomStatus Addr_Type DeliverTyp".split())
TOKEN_ROWS = 100


def quality(raw: DataFrame) -> DataFrame:
    """Rows of each group with missing, odd or repeated values, and the spans of positions and updates."""
    lon, lat, name, zip_code = degrees(F.col("Longitude")), degrees(F.col("Latitude")), F.col("St_Name"), F.col("Zip_Code")
    letters = name.rlike("[A-Za-z]")
    when: dict[str, Column] = {
        "street_name_all_caps": (name == F.upper(name)) & letters, "street_name_with_letters": letters, "no_number": F.col("Add_Number").isNull(), "zero_number": whole_number(F.trim("Add_Number")) == 0,
        "no_street_name": name.isNull(), "no_coords": lon.isNull() | lat.isNull(), "zero_coords": (lon == 0) | (lat == 0), "bad_zip": ~zip_code.rlike(r"\A[0-9]{5}\z"),
    }
    spans = [f(c).alias(f"{f.__name__}_{n}") for c, n in ((lon, "lon"), (lat, "lat")) for f in (F.min, F.max)] + [F.min("DateUpdate").alias("oldest_update"), F.max("DateUpdate").alias("newest_update")]
    own = raw.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(condition).alias(n) for n, condition in when.items()), *spans)
    copies = {"shared_coords": ("Longitude", "Latitude"), "exact_duplicates": ("AddNo_Full", "StNam_Full", "SubAddress", "Zip_Code", "Longitude", "Latitude"), "repeated_uuid": ("UUID",)}
    same = lambda a, b: reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[f"{c}__"]) for c in GROUP))
    for n, columns in copies.items():
        found = profiling.repeats(raw, GROUP, columns, n).withColumnsRenamed({c: f"{c}__" for c in GROUP})
        own = own.join(found, same(own, found)).drop(*(f"{c}__" for c in GROUP))
    return own


def street_parts(raw: DataFrame) -> DataFrame:
    """(col, val, n, sources, states): all values of the street's parts."""
    counted = profiling.long_values(raw, GROUP, STREET_PARTS).groupBy("col", "val", *GROUP).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("col", "val").agg(F.sum("n").alias("n"), F.count_distinct("NAD_Source").alias("sources"), F.count_distinct("State").alias("states"))


def name_tokens(raw: DataFrame, least: int = TOKEN_ROWS) -> DataFrame:
    """(position, token, n, states): first words of street names, and last ones of names with several."""
    words = F.split(F.upper(F.trim("St_Name")), " ")
    ends = F.array(F.struct(F.lit("first").alias("position"), F.element_at("w", 1).alias("token")), F.struct(F.lit("last").alias("position"), F.when(F.size("w") > 1, F.element_at("w", -1)).alias("token")))
    rows = raw.where("St_Name is not null").select("State", words.alias("w")).select("State", F.explode(ends).alias("x")).select("State", "x.*").where("token is not null")
    counted = rows.groupBy("position", "token", "State").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("position", "token").agg(F.sum("n").alias("n"), F.count_distinct("State").alias("states")).where(F.col("n") >= least)


def write_profile(raw: DataFrame, folder: str, top: int = 20, tokens: int = TOKEN_ROWS) -> list[str]:
    """The five reports of a raw table, as CSV files."""
    counties = raw.select(*GROUP, "County").distinct().groupBy(*GROUP).agg(F.count("County").alias("counties"))
    same = lambda a, b: reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[c]) for c in GROUP))
    rates = profiling.fill_rates(raw, GROUP, [c for c in RAW_COLUMNS if c not in GROUP])
    rates = rates.join(counties, same(rates, counties)).drop(*(counties[c] for c in GROUP))
    reports = {
        "fill_rates": (rates, GROUP),
        "top_values": (profiling.top_values(raw, GROUP, VALUES, top), (*GROUP, "col", "place")),
        "street_parts": (street_parts(raw), ("col", F.desc("n"), "val")),
        "street_name_tokens": (name_tokens(raw, tokens), ("position", F.desc("n"), "token")),
        "quality": (quality(raw), GROUP),
    }
    for name, (rows, order) in reports.items():
        sinks.write_report(rows, f"{folder}/{name}", *order)
    return list(reports)


def write_references(names: DataFrame, folder: str) -> None:
    """The different names (state, name, source) of all reference lists, and the keys that have several spellings."""
    distinct = names.select("state", "name", "source").distinct()
    sinks.write_report(distinct, f"{folder}/place_names", "state", "name", "source")
    sinks.write_report(place_names.conflicts(distinct), f"{folder}/place_name_conflicts", "state", "chosen")


def build_sources(spark: SparkSession, sources: Sequence[Source], folder: str, rows_of: Callable[[Source], DataFrame], counties: DataFrame | None = None, only: Sequence[str] = ()) -> list[dict]:
    """Writes each declared source's rows in the raw layout below its state, and gives a manifest of each."""
    manifests = []
    for source in sources:
        if only and source.id not in only:
            continue
        target = f"{folder}/{source.id}"
        publishing.write_single(raw_rows(rows_of(source), source, counties), target, source.state)
        n = spark.read.parquet(f"{target}/State={source.state}").count()
        manifests.append({"id": source.id, "name": source.title, "publisher": source.publisher, "licence": dict(source.terms), "url": source.access.url, "rows": n, "fetched": datetime.now().astimezone().isoformat(timespec="seconds")})
    return manifests


def export(points: DataFrame, folder: str, release: str, name: str, attribution: str, built: str | None = None) -> dict:
    """Writes features by state, the tile archive and its sidecar of a release's kept points; gives the sidecar."""
    publishing.write_features(points, f"{folder}/geojson")
    made = write_archive(points, f"{folder}/{name}-{release}.pmtiles", metadata={"name": f"{name} {release}", "attribution": attribution})
    sidecar = {"release": release, "built": built or date.today().isoformat(), **made}
    if "://" not in folder:
        Path(folder, f"{name}-{release}.json").write_text(json.dumps(sidecar, indent=2), encoding="utf-8")
    return sidecar
