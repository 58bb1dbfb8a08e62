"""Paged feature layers as a data source: one input partition per range of ids, asked for again where a task is lost."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from waymark.functions.columns import clean
from waymark.sources.remote import get_json, id_pages

POSITION = ("_lon", "_lat")
#: Rows that are asked for at once, if the service allows as many.
PAGE = 2000


@dataclass
class IdRange(InputPartition):
    low: int
    high: int


class LayerReader(DataSourceReader):
    """Reads a layer's attributes as text, and positions in degrees.

    Filters on attributes are put into the requests as well, where the service's types allow it; the engine still
    applies them itself, so a service that reads them in its own way changes nothing.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.url, self.columns = options["url"], json.loads(options["columns"])
        self.tries, self.wait, self.page = int(options.get("tries", 4)), float(options.get("wait", 10)), int(options.get("page", PAGE))
        self.conditions = [options["where"]] if options.get("where") else []
        self.key = None

    def ask(self, url: str, query: dict) -> dict:
        return get_json(url, {"f": "json", **query}, self.tries, lambda n: self.wait * 3**n)

    def about(self) -> dict:
        return self.ask(self.url, {})

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        kinds = {field["name"]: field["type"] for field in self.about().get("fields", ())}
        text = lambda value: "'" + str(value).replace("'", "''") + "'"
        for filter in filters:
            name = ".".join(filter.attribute)
            if name in kinds and isinstance(filter, IsNotNull):
                self.conditions.append(f"{name} IS NOT NULL")
            elif kinds.get(name) == "esriFieldTypeString" and isinstance(filter, EqualTo | In):
                values = filter.value if isinstance(filter, In) else [filter.value]
                if all(isinstance(value, str) for value in values):
                    self.conditions.append(f"{name} IN ({', '.join(map(text, values))})")
            yield filter

    def partitions(self) -> list[IdRange]:
        about = self.about()
        self.key = about.get("objectIdField") or next(f["name"] for f in about["fields"] if f["type"] == "esriFieldTypeOID")
        wanted = [{"statisticType": kind, "onStatisticField": self.key, "outStatisticFieldName": name} for kind, name in (("min", "LO"), ("max", "HI"))]
        span = self.ask(f"{self.url}/query", {"where": self.where(), "outStatistics": json.dumps(wanted)}).get("features") or [{"attributes": {}}]
        ends = {name.upper(): value for name, value in span[0]["attributes"].items()}
        if ends.get("LO") is None:
            return []
        size = min(self.page, int(about.get("maxRecordCount") or self.page))
        return [IdRange(low, high) for low, high in id_pages(int(ends["LO"]), int(ends["HI"]), size)]

    def where(self, ids: IdRange | None = None) -> str:
        said = [f"({condition})" for condition in self.conditions]
        return " AND ".join([*([f"{self.key} BETWEEN {ids.low} AND {ids.high}"] if ids else []), *said]) or "1=1"

    def read(self, partition: IdRange | None) -> Iterator[tuple]:
        if partition is None:
            return
        asked = {"where": self.where(partition), "outFields": ",".join(self.columns), "returnGeometry": "true", "outSR": 4326, "orderByFields": self.key}
        for feature in self.ask(f"{self.url}/query", asked)["features"]:
            values, at = feature["attributes"], feature.get("geometry") or {}
            number = lambda value: None if value is None else float(value)
            yield (*(None if values.get(c) is None else str(values[c]) for c in self.columns), number(at.get("x")), number(at.get("y")))


class FeatureLayer(DataSource):
    """Options: url, columns (a JSON list), where, page, tries, wait (seconds before the second try, growing)."""

    @classmethod
    def name(cls) -> str:
        return "feature_layer"

    def schema(self) -> str:
        quoted = [f"`{name}` string" for name in json.loads(self.options["columns"])]
        return ", ".join([*quoted, *(f"{name} double" for name in POSITION)])

    def reader(self, schema: object) -> LayerReader:
        return LayerReader(dict(self.options))


def read_layer(spark: SparkSession, url: str, columns: Iterable[str], **options: object) -> DataFrame:
    """A layer's columns as text, with _lon and _lat; null where a feature has no geometry."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeatureLayer)
    return spark.read.format("feature_layer").options(url=url, columns=json.dumps(list(columns)), **options).load()


def read_communities(spark: SparkSession, url: str, state: str, number: str, community: str, **options: object) -> DataFrame:
    """(state, number, community, lon, lat) of a state's layer: only rows that have all of them, since others can fill nothing."""
    rows = read_layer(spark, url, [number, community], **options)
    named = rows.select(F.lit(state).alias("state"), F.col(f"`{number}`").alias("number"), clean(F.col(f"`{community}`")).alias("community"), F.col("_lon").alias("lon"), F.col("_lat").alias("lat"))
    return named.where("number is not null and community is not null and lon is not null and lat is not null")
