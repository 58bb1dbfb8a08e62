"""Reports for reviewers: where unknown cities lie, what they may be misspelled from, and how points compare with a map."""

from __future__ import annotations

from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.columns import kilometres, metres
from waymark.operators import spatial
from waymark.operators.closest import closest_names
from waymark.operators.memo import apply_rule
from waymark.operators.python_rules import close_enough, place_key, resembles, scored_edits

# The share that makes a majority, cities of a street that are looked at, and reaches in km and metres.
MAJORITY, STREET_CITIES = 0.5, 6
HAMLET_KM, SUPPORT_KM, MATCH_METRES = 25.0, 5.0, 100.0
DIRECTIONALS = ("north", "south", "east", "west", "northeast", "northwest", "southeast", "southwest")
UNKNOWN = "city_not_in_reference"


def top(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """(by, name, name_n): the most frequent value of each group, ties by alphabet; nulls don't count."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    best = counted.groupBy(*by).agg(F.min(F.struct((-F.col("c")).alias("less"), F.col(value).alias("v"), "c")).alias("best"))
    return best.select(*by, F.col("best.v").alias(name), F.col("best.c").alias(f"{name}_n"))


def bucket(city: str, in_place: Column) -> Column:
    """The bucket of a value from the shares of its points in its commonest place and town."""
    in_top, in_town = F.coalesce(F.col("place_share"), F.lit(0.0)) >= MAJORITY, F.coalesce(F.col("town_share"), F.lit(0.0)) >= MAJORITY
    ladder = F.when(F.col("like_place") & in_top, "correction_place").when(F.col("like_town") & in_town, "correction_cousub")
    return ladder.when(in_top, "differs_from_place").when(in_place >= MAJORITY, "split_across_places").otherwise("outside_places")


def city_triage(points: DataFrame, places: DataFrame, towns: DataFrame, zips: DataFrame, known: Broadcast | None = None) -> DataFrame:
    """A row per state and unknown city: how many points, in which place, town and ZIP most, its bucket, a sample and holds."""
    chosen = points.where("drop_reason is null").where(F.array_contains("flags", UNKNOWN))
    own = chosen.select("nad_oid", F.col("addr_state").alias("state"), "county", F.col("addr_city").alias("city"), F.col("addr_postcode").alias("zip"), F.concat_ws(" ", "addr_housenumber", "addr_street").alias("address"), (F.col("addr_housenumber").isNotNull() & F.col("addr_street").isNotNull()).alias("whole"), "lon", "lat")
    inside = lambda rows, shapes, name, by: spatial.points_in_polygons(rows, shapes, "nad_oid", "name", by).withColumnRenamed("name", name)
    for found in (inside(own, places, "place", ["state"]), inside(own, towns, "town", ["state"]), inside(own.where("zip is null"), zips, "area", [])):
        own = own.join(found, "nad_oid", "left")
    own = own.withColumns({"from_area": F.col("zip").isNull(), "zip": F.coalesce("zip", "area")})
    by = ["state", "city"]
    sentinel = F.coalesce("county", F.lit("\u0000"))
    total = own.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count("place").alias("n_place"), F.array_sort(F.collect_set(sentinel)).alias("counties"))
    zip_rows = own.where("zip is not null").groupBy(*by, "zip").agg(F.bool_and("from_area").alias("from_area"), F.count(F.lit(1)).alias("c"))
    top_zip = zip_rows.groupBy(*by).agg(F.min(F.struct((-F.col("c")).alias("less"), "zip", "from_area")).alias("best")).select(*by, F.col("best.zip").alias("top_zip"), F.when(F.col("best.from_area"), "zcta").otherwise("source").alias("zip_from"))
    sample = own.where("whole").join(top_zip, by, "left").groupBy(*by).agg(F.max_by("address", F.struct(F.col("zip").eqNullSafe(F.col("top_zip")).cast("int").alias("same"), "address")).alias("sample_address"))
    rows = total.join(top(own, by, "place", "top_place"), by, "left").join(top(own, by, "town", "top_town"), by, "left").join(top_zip, by, "left").join(sample, by, "left")
    rows = rows.withColumns({"place_share": F.col("top_place_n") / F.col("n"), "town_share": F.col("top_town_n") / F.col("n"), "like_place": F.coalesce(resembles("city", "top_place"), F.lit(False)), "like_town": F.coalesce(resembles("city", "top_town"), F.lit(False))})
    rows = rows.withColumn("bucket", bucket("city", F.col("n_place") / F.col("n")))
    suggested = F.when(F.col("bucket").isin("correction_cousub", "outside_places"), F.col("top_town")).otherwise(F.col("top_place"))
    held = F.lit(None).cast("string")
    if known is not None:
        held = F.udf(lambda state, city, counties: _holds(known.value, state, city, counties), "string", useArrow=True)("state", "city", "counties")
    share = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 2)
    return rows.select("state", "city", "n", "bucket", suggested.alias("suggested"), share("place_share").alias("place_share"), "top_place", share("town_share").alias("town_share"), "top_town", "top_zip", "zip_from", "sample_address", held.alias("review"))


def _holds(known, state: str, city: str, counties: list[str]) -> str | None:
    """Notes of the holds on a city in any of its counties; a null county stands as a zero character."""
    notes = {known.decided("hold", state, None if county == "\u0000" else county, city) for county in counties} if city else set()
    return "; ".join(f"hold: {note}" if note else "hold" for note in sorted(n for n in notes if n is not None)) or None


def typo_candidates(points: DataFrame, places: DataFrame, hamlets: DataFrame, known: Broadcast) -> DataFrame:
    """A row per state, county and unknown city with the known place it is most likely a misspelling of.

    Evidence: cities of the same streets, the place around most points, and hamlets (state, name, lon, lat) near
    their centre. The candidate of the fewest edits wins, then street before place before hamlet, the larger share,
    the shorter way. support lists which kinds of evidence name it. The most frequent come first.
    """
    kept = points.where("drop_reason is null and addr_city is not null").select(F.col("addr_state").alias("state"), "county", F.col("addr_city").alias("city"), F.col("addr_street").alias("street"), F.col("addr_postcode").alias("zip"), F.concat(F.col("addr_housenumber"), F.lit(" "), F.col("addr_street")).alias("address"), "lon", "lat", F.array_contains("flags", UNKNOWN).alias("unknown"))
    spelled = F.udf(lambda state, name: known.value.known(state, None, name) if name else None, "string", useArrow=True)
    held = F.udf(lambda state, county, city: known.value.decided("hold", state, county, city) is not None, "boolean", useArrow=True)
    unknown = kept.where("unknown")
    group = ["state", "county", "city"]
    groups = unknown.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.mode("zip", True).alias("top_zip"), F.min("address").alias("sample_address")).where(~held(*group))
    groups = groups.withColumn("g", F.xxhash64(*(F.coalesce(c, F.lit("\u0000")) for c in group)))

    known_rows = kept.where("not unknown")
    streets = unknown.where("street is not null").select(*group, "street").distinct().withColumn("g", F.xxhash64(*(F.coalesce(c, F.lit("\u0000")) for c in group))).select("g", "state", "county", "street")
    of_street = streets.alias("s").join(known_rows.select(F.col("state").alias("state2"), F.col("county").alias("county2"), F.col("street").alias("street2"), F.col("city").alias("name")), (F.col("state") == F.col("state2")) & F.col("county").eqNullSafe(F.col("county2")) & (F.col("street") == F.col("street2")))
    street_cities = of_street.groupBy("g", "name").agg(F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy("g").orderBy(F.desc("c"), "name")
    street_cities = street_cities.withColumns({"share": F.col("c") / F.sum("c").over(Window.partitionBy("g")), "place": F.row_number().over(order)})
    by_street = street_cities.where(F.col("place") <= STREET_CITIES).select("g", "name", F.lit(0).alias("via"), "share", F.lit(None).cast("double").alias("km"))
    top_street = street_cities.where("place = 1").select("g", F.col("name").alias("top_street_city"), F.col("share").alias("top_street_share"))

    numbered = unknown.withColumn("g", F.xxhash64(*(F.coalesce(c, F.lit("\u0000")) for c in group))).withColumn("row", F.struct("g", F.monotonically_increasing_id().alias("k"), "lon", "lat"))
    inside = spatial.points_in_polygons(numbered.select("row", "state", "lon", "lat"), places, "row", "name", ["state"]).select("row.g", "name")
    place_top = top(inside, ["g"], "name", "name").join(groups.select("g", "n"), "g").select("g", "name", (F.col("name_n") / F.col("n")).alias("share"))
    by_place = place_top.select("g", "name", F.lit(1).alias("via"), "share", F.lit(None).cast("double").alias("km"))

    near = spatial.neighbours(groups.select("g", "state", "lon", "lat"), hamlets.select("state", "name", "lon", "lat"), HAMLET_KM / 111.2, ["state"])
    by_hamlet = near.withColumn("km", kilometres(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).where(F.col("km") <= HAMLET_KM).select("g", "name", F.lit(2).alias("via"), F.lit(0.0).alias("share"), "km")

    options = by_street.unionByName(by_place).unionByName(by_hamlet).join(groups.select("g", "state", "city"), "g").withColumn("spelling", spelled("state", "name")).where("spelling is not null")
    options = apply_rule(options, ["city", "name"], scored_edits, "edits")
    options = apply_rule(options, ["name"], place_key, "key")
    best = options.groupBy("g").agg(F.min(F.struct("edits", "via", (-F.col("share")).alias("less"), F.coalesce("km", F.lit(0.0)).alias("way"), "name", "spelling", "key", "km")).alias("best"))
    near_key = options.where((F.col("via") == 2) & (F.col("km") <= SUPPORT_KM)).select("g", F.col("key").alias("near_key")).distinct().groupBy("g").agg(F.collect_set("near_key").alias("near_keys"))

    zips = groups.select("state", F.col("top_zip").alias("zip")).where("zip is not null").distinct()
    zip_counts = known_rows.join(zips, ["state", "zip"], "left_semi").groupBy("state", "zip", "city").agg(F.count(F.lit(1)).alias("c"))
    zip_city = zip_counts.groupBy("state", "zip").agg(F.min(F.struct((-F.col("c")).alias("less"), "city", "c")).alias("z"), F.sum("c").alias("all")).select("state", F.col("zip").alias("top_zip"), F.col("z.city").alias("zip_city"), (F.col("z.c") / F.col("all")).alias("zip_city_share"))

    rows = groups.join(best, "g").join(top_street, "g", "left").join(place_top.select("g", F.col("name").alias("place_name"), F.col("share").alias("place_share")), "g", "left").join(near_key, "g", "left").join(zip_city, ["state", "top_zip"], "left")
    rows = rows.where(close_enough("city", "best.name", "best.edits"))
    key = lambda c: place_key(F.col(c))
    same = lambda c: F.coalesce(key(c) == F.col("best.key"), F.lit(False))
    support = F.array_compact(F.array(F.when(same("top_street_city"), "street"), F.when(same("place_name") & (F.col("place_share") >= MAJORITY), "place"), F.when(same("zip_city"), "zip"), F.when(F.coalesce(F.array_contains("near_keys", F.col("best.key")), F.lit(False)), "gnis")))
    via = F.element_at(F.array(F.lit("street"), F.lit("place"), F.lit("gnis")), F.col("best.via") + 1)
    return rows.select("state", "county", "city", "n", F.col("best.spelling").alias("candidate"), via.alias("via"), F.round(-F.col("best.less"), 2).alias("share"), F.round("best.km", 1).alias("km"), F.col("best.edits").alias("edits"), F.array_join(support, "+").alias("support"), "top_street_city", F.round("top_street_share", 2).alias("top_street_share"), "top_zip", "zip_city", F.round("zip_city_share", 2).alias("zip_city_share"), "sample_address", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon")).orderBy(F.desc("n"), "state", "city", "county")


def text_key(column: Column) -> Column:
    """Case and spaces don't matter."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(column, F.lit(""))), r"\s+", " "))


def number_key(column: Column) -> Column:
    return F.replace(text_key(column), F.lit(" "), F.lit(""))


def punctuation_key(column: Column) -> Column:
    bare = F.regexp_replace(F.replace(text_key(column), F.lit("&"), F.lit(" and ")), "['’.]", "")
    return F.trim(F.regexp_replace(F.replace(bare, F.lit("-"), F.lit(" ")), r"\s+", " "))


def direction_parts(column: Column) -> Column:
    """struct<pre, core, post> of a name's key: directions at its ends, if other words remain."""
    words = F.split(text_key(column), " ")
    leads = (F.size(words) > 1) & F.element_at(words, 1).isin(*DIRECTIONALS)
    rest = F.when(leads, F.slice(words, 2, F.size(words) - 1)).otherwise(words)
    ends = (F.size(rest) > 1) & F.element_at(rest, -1).isin(*DIRECTIONALS)
    core = F.when(ends, F.slice(rest, 1, F.size(rest) - 1)).otherwise(rest)
    return F.struct(F.when(leads, F.element_at(words, 1)).otherwise("").alias("pre"), F.array_join(core, " ").alias("core"), F.when(ends, F.element_at(rest, -1)).otherwise("").alias("post"))


def directional_difference(a: Column, b: Column) -> Column:
    """Whether two direction_parts are equal but for a direction that one of them lacks."""
    lacks = lambda x, y: (x == y) | (x == "") | (y == "")
    return (a["core"] == b["core"]) & ((a["pre"] != b["pre"]) | (a["post"] != b["post"])) & lacks(a["pre"], b["pre"]) & lacks(a["post"], b["post"])


def street_matches(points: DataFrame, roads: DataFrame) -> DataFrame:
    """(street, n, how, road): each street of points and how roads (name, alternate) of the area carry it.

    exact, alternate, case_only, punctuation_only, directional_only by equi-joins on derived keys; unmatched streets
    get the closest name, which is looked for only there, by operators/closest.py.
    """
    streets = points.where("street is not null and street <> ''").groupBy("street").agg(F.count(F.lit(1)).alias("n"))
    names = roads.where("name is not null")
    best = lambda rows, key: rows.groupBy(key).agg(F.min("name").alias(f"{key}_road"))
    exact = names.where("not alternate").select(F.col("name").alias("street"), F.col("name").alias("exact_road")).distinct()
    alternate = names.where("alternate").select(F.col("name").alias("street"), F.col("name").alias("alternate_road")).distinct()
    keyed = names.withColumns({"case_key": text_key(F.col("name")), "punctuation_key": punctuation_key(F.col("name"))})
    own = streets.withColumns({"case_key": text_key(F.col("street")), "punctuation_key": punctuation_key(F.col("street")), "parts": direction_parts(F.col("street"))}).withColumn("core", F.col("parts.core"))
    own = own.join(exact, "street", "left").join(alternate, "street", "left").join(best(keyed, "case_key"), "case_key", "left").join(best(keyed, "punctuation_key"), "punctuation_key", "left")
    parts = names.select("name", direction_parts(F.col("name")).alias("road_parts")).withColumn("core", F.col("road_parts.core"))
    left = own.where("exact_road is null and alternate_road is null and case_key_road is null and punctuation_key_road is null")
    directional = left.join(parts, "core").where(directional_difference(F.col("parts"), F.col("road_parts"))).groupBy("street").agg(F.min("name").alias("directional_road"))
    own = own.join(directional, "street", "left")
    ladder = (("exact", "exact_road"), ("alternate", "alternate_road"), ("case_only", "case_key_road"), ("punctuation_only", "punctuation_key_road"), ("directional_only", "directional_road"))
    how, road = F.lit("unmatched"), F.lit(None).cast("string")
    for name, column in reversed(ladder):
        how, road = F.when(F.col(column).isNotNull(), name).otherwise(how), F.when(F.col(column).isNotNull(), F.col(column)).otherwise(road)
    return own.select("street", "n", how.alias("how"), road.alias("road"))


def address_matches(points: DataFrame, mapped: DataFrame, radius: float = MATCH_METRES) -> DataFrame:
    """A row per distinct number and street of points (id, housenumber, street, city, postcode, lon, lat), and how the map has it.

    outcome: matched, matched_directional_differs, street_conflict (the number is near, on another street) or
    not_in_osm; with the nearest mapped address that decides it, and whether its city and postcode differ.
    """
    key = lambda rows: rows.withColumns({"number_key": number_key(F.col("housenumber")), "street_key": text_key(F.col("street"))})
    own = key(points).where("number_key <> ''")
    own = own.groupBy("number_key", "street_key").agg(F.min(F.struct("id", "street", "city", "postcode", "lon", "lat")).alias("p")).select("number_key", "street_key", "p.*", direction_parts(F.col("p.street")).alias("parts"))
    other = key(mapped).select(direction_parts(F.col("street")).alias("parts2"), "number_key", F.col("street_key").alias("street_key2"), F.col("street").alias("street2"), F.col("city").alias("city2"), F.col("postcode").alias("postcode2"), "lon", "lat")
    reach = radius / 111_320.0
    pairs = spatial.neighbours(own, other, 0.001, ["number_key"], reach)
    off = metres(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    near = pairs.withColumn("off", off).where(F.col("off") <= radius)
    kind = F.when(F.col("street_key") == F.col("street_key2"), 0).when(directional_difference(F.col("parts"), F.col("parts2")), 1).otherwise(2)
    best = near.withColumn("kind", kind).groupBy("number_key", "street_key").agg(F.min(F.struct("kind", "off", "street2", "city2", "postcode2")).alias("m"))
    rows = own.join(best, ["number_key", "street_key"], "left")
    outcome = F.when(F.col("m.kind") == 0, "matched").when(F.col("m.kind") == 1, "matched_directional_differs").when(F.col("m.kind") == 2, "street_conflict").otherwise("not_in_osm")
    matched = F.col("m.kind") < 2
    differs = lambda mine, theirs: F.coalesce(matched & theirs.isNotNull() & (theirs != "") & ~mine.eqNullSafe(theirs), F.lit(False))
    return rows.select("id", "number_key", "street_key", outcome.alias("outcome"), F.col("m.street2").alias("mapped_street"), F.round("m.off", 4).alias("metres_off"), differs(F.col("city"), F.col("m.city2")).alias("city_differs"), differs(F.col("postcode"), F.substring("m.postcode2", 1, 5)).alias("postcode_differs"))


def only_mapped(points: DataFrame, mapped: DataFrame, radius: float = MATCH_METRES) -> DataFrame:
    """Keys of mapped addresses that match no point."""
    keys = mapped.select(number_key(F.col("housenumber")).alias("number_key"), text_key(F.col("street")).alias("street_key")).distinct()
    met = address_matches(points, mapped, radius).where("outcome like 'matched%'").select("number_key", text_key(F.col("mapped_street")).alias("street_key"))
    return keys.join(met, ["number_key", "street_key"], "left_anti")


def most_common(rows: DataFrame, column: str, k: int | None = None) -> list[tuple[str | None, int]]:
    """Values and how often they occur, most frequent first, ties by alphabet; nulls of a limited list don't count."""
    counted = (rows.where(F.col(column).isNotNull()) if k else rows).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(column))
    return [(row[0], row[1]) for row in (counted.limit(k) if k else counted.limit(10_000)).collect()]


def spot_check(points: DataFrame, mapped: DataFrame, roads: DataFrame, radius: float = MATCH_METRES, units: int = 40) -> dict:
    """The summary of an area: points (id, housenumber, street, city, postcode, unit, source, lon, lat) against mapped addresses and roads (name, alternate)."""
    matches = address_matches(points, mapped, radius).persist()
    streets = street_matches(points, roads).persist()
    outcomes = {row.outcome: row["n"] for row in matches.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
    how = {row.how: (row.n_streets, row.n_points) for row in streets.groupBy("how").agg(F.count(F.lit(1)).alias("n_streets"), F.sum("n").alias("n_points")).collect()}
    unmatched = streets.where("how = 'unmatched'")
    near = closest_names(unmatched, roads).join(unmatched.select("street", "n"), "street").orderBy(F.desc("n"), "street").limit(units).collect()
    totals = points.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("city").isNull() | (F.col("city") == "")).alias("no_city")).first()
    conflicts = matches.where("outcome = 'street_conflict'").select(F.concat_ws(" / ", "street_key", "mapped_street").alias("streets"))
    summary = {
        "source_points": totals["n"], "no_city": totals["no_city"], "source_names": most_common(points, "source"), "units": most_common(points.withColumn("unit", F.nullif("unit", F.lit(""))), "unit", units),
        "osm_addresses": mapped.count(), "osm_street_names": roads.where("not alternate").select("name").distinct().count(), "streets": how, "closest": [(row.street, row.closest) for row in near],
        "addresses": {**outcomes, "distinct": sum(outcomes.values()), "osm_only": only_mapped(points, mapped, radius).count(), "city_differs": matches.where("city_differs").count(), "postcode_differs": matches.where("postcode_differs").count(), "street_conflicts": most_common(conflicts, "streets", units)},
    }
    matches.unpersist()
    streets.unpersist()
    return summary
