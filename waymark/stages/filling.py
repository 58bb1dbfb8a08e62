"""Fills of missing cities and postcodes; only nulls are filled, and each fill is flagged."""

from __future__ import annotations

from functools import reduce

from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import METRES_PER_DEGREE, whole_number
from waymark.operators import spatial

# States where towns cover all land; how far a source's point may be, in metres.
TOWN_STATES = ("CT", "MA", "ME", "NH", "NJ", "NY", "RI", "VT")
MATCH_METRES = 100.0
CELL = 0.001


def _reflagged(flags: Column, city: Column, *added: tuple[Column, str]) -> Column:
    """The flags without no_city where a city was found, and with those added whose condition holds."""
    kept = F.filter(flags, lambda f: ~((f == "no_city") & city.isNotNull()))
    return F.array_sort(F.concat(kept, F.array_compact(F.array(*(F.when(condition, F.lit(name)) for condition, name in added)))))


def community_matches(points: DataFrame, communities: DataFrame, metres: float = MATCH_METRES) -> DataFrame:
    """(nad_oid, state, community): the nearest community point of the same state and number, for kept points without a city.

    communities: (state, number as text, community, lon, lat). Near means a box, not a circle; the nearest is by
    the sum of the differences, ties by name.
    """
    reach = metres / METRES_PER_DEGREE
    number = whole_number(F.regexp_extract("addr_housenumber", r"([0-9]+)", 1))
    need = points.where("drop_reason is null and addr_city is null").select("nad_oid", F.col("addr_state").alias("state"), number.alias("number"), "lon", "lat").where("number is not null")
    known = communities.select("state", whole_number(F.trim("number")).alias("number"), "community", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat")).where("number is not null")
    pairs = spatial.neighbours(need, known, CELL, ["state", "number"], reach)
    dlat, dlon = F.abs(F.col("lat2") - F.col("lat")), F.abs(F.col("lon2") - F.col("lon"))
    near = pairs.where((dlat <= reach) & (dlon * F.cos(F.radians("lat")) <= reach))
    best = near.groupBy("nad_oid", "state").agg(F.min(F.struct((dlat + dlon).alias("off"), "community")).alias("best"))
    return best.select("nad_oid", "state", "best.community")


def community_cities(communities: DataFrame, known: Broadcast) -> DataFrame:
    """(state, community, city): communities that are known places of their state, as spelled there."""
    spelled = F.udf(lambda state, name: known.value.known(state, None, name) if name else None, "string", useArrow=True)
    return communities.select("state", "community").distinct().withColumn("city", spelled("state", "community"))


def supplement(points: DataFrame, matches: DataFrame, cities: DataFrame) -> DataFrame:
    """The points with cities from communities."""
    found = matches.join(cities, ["state", "community"], "left").select("nad_oid", F.col("city").alias("city__"))
    own = points.join(found, "nad_oid", "left").withColumn("found__", F.when(F.col("addr_city").isNull(), F.col("city__")))
    city = F.col("found__")
    flagged = own.withColumn("flags", F.when(city.isNotNull(), _reflagged(F.col("flags"), city, (F.lit(True), "city_from_source_msag"))).otherwise(F.col("flags")))
    return flagged.withColumn("addr_city", F.coalesce("addr_city", "found__")).select(*points.columns)


def supplement_report(matches: DataFrame, cities: DataFrame) -> DataFrame:
    return matches.join(cities, ["state", "community"], "left").groupBy("state", "community", F.col("city").alias("filled_as")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy("state", F.desc("n_rows"))


def backfill(points: DataFrame, places: DataFrame, towns: DataFrame, zips: DataFrame, facts: DataFrame) -> DataFrame:
    """The points with cities from their own ZIP, the place or the town around them, and postcodes from ZIP areas.

    places and towns: (state, name, rings); zips: (name, rings); facts: (state, zip, city), one city a ZIP. A ZIP
    that is filled here says nothing about the city.
    """
    need = points.where("drop_reason is null and (addr_city is null or addr_postcode is null)").select("nad_oid", F.col("addr_state").alias("state"), "addr_postcode", "lon", "lat", F.col("addr_city").isNull().alias("need_city"))
    by_zip = need.where("need_city").join(facts, (need.state == facts.state) & (need.addr_postcode == facts.zip)).select("nad_oid", F.col("city").alias("zip__"))
    inside = lambda rows, shapes, name, by: spatial.points_in_polygons(rows, shapes, "nad_oid", "name", by).withColumnRenamed("name", name)
    by_place = inside(need.where("need_city"), places, "place__", ["state"])
    by_town = inside(need.where("need_city").where(F.col("state").isin(*TOWN_STATES)), towns, "town__", ["state"])
    by_area = inside(need.where("addr_postcode is null"), zips, "area__", [])
    kinds = {"zip__": by_zip, "place__": by_place, "town__": by_town, "area__": by_area}
    either = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds.values())
    fills = either.groupBy("nad_oid").agg(*(F.min(name).alias(name) for name in kinds))  # of needy rows alone, one row an id
    own = points.join(fills, "nad_oid", "left").withColumn("found__", F.coalesce("zip__", "place__", "town__"))
    city = F.col("found__")
    ours = F.col("addr_city").isNull()
    marks = (ours & F.col("zip__").isNotNull(), "city_from_zip"), (ours & F.col("zip__").isNull() & F.col("place__").isNotNull(), "city_from_census_place"), (ours & F.coalesce("zip__", "place__").isNull() & F.col("town__").isNotNull(), "city_from_census_cousub"), (F.col("addr_postcode").isNull() & F.col("area__").isNotNull(), "postcode_from_zcta")
    flagged = own.withColumn("flags", _reflagged(F.col("flags"), city, *marks))  # first: names in lambdas would be taken for the new columns
    return flagged.withColumns({"addr_city": F.coalesce(F.col("addr_city"), city), "addr_postcode": F.coalesce("addr_postcode", "area__")}).select(*points.columns)
