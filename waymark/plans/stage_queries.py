"""Driver-facing queries of the stages, with their SQL. Places are derived from integer keys, as in address_queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import spatial
from waymark.plans.address_queries import BOX, boxes, located, place, query, read
from waymark.plans.rule_queries import known_places
from waymark.sources import sinks
from waymark.sources.shared import shared_folder
from waymark.stages import counts, coverage, deduplication, filling, review

NOTHING = "array<string>"


def shapes(spark: SparkSession, d: str, grow: float = 9.0, tall: float = 4.0) -> DataFrame:
    """(name, rings) of a box for each nation."""
    return boxes(read(spark, d, "nation"), grow, tall).withColumnRenamed("region", "name")


@query(f"""WITH c AS (SELECT c_custkey, c_nationkey % 2 AS st, {place('c_custkey')} FROM customer), b AS (SELECT region, x, y, n_nationkey % 2 AS st FROM ({BOX}) JOIN nation ON n_name = region)
SELECT c_custkey::BIGINT AS c_custkey, min(region) AS region FROM c JOIN b ON c.st = b.st AND lon > x AND lon < x + 9.0 AND lat > y AND lat < y + 4.0 GROUP BY c_custkey""")
def point_in_region_by_state(spark, d):
    nation = read(spark, d, "nation").select(F.col("n_name").alias("region"), (F.col("n_nationkey") % 2).alias("st"))
    points = located(read(spark, d, "customer"), "c_custkey").withColumn("st", F.col("c_nationkey") % 2)
    return spatial.points_in_polygons(points, boxes(read(spark, d, "nation"), 9.0, 4.0).join(nation, "region"), "c_custkey", "region", ["st"])


def _two_sources(spark, d):
    a = located(read(spark, d, "customer"), "c_custkey").select(F.lit("own").alias("nad_source"), "lon", "lat", F.when(F.col("c_acctbal") < 0, "duplicate").alias("drop_reason"))
    b = located(read(spark, d, "supplier").withColumn("k", F.col("s_suppkey") * 3), "k").select(F.lit("extra").alias("nad_source"), "lon", "lat", F.lit(None).cast("string").alias("drop_reason"))
    return a.unionByName(b)


@query(f"""WITH p AS (SELECT 'own' AS source, {place('c_custkey')} FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'extra', {place('s_suppkey * 3')} FROM supplier), g AS (SELECT source, round(lon * 100)::BIGINT AS gx, round(lat * 100)::BIGINT AS gy, avg(lon) AS lon, avg(lat) AS lat, count(*) AS n FROM p GROUP BY source, round(p.lon * 100), round(p.lat * 100)),
b AS ({BOX}), d AS (SELECT source, gx, gy, n, region, greatest(x - lon, 0.0, lon - x - 9.0) AS dx, greatest(y - lat, 0.0, lat - y - 4.0) AS dy FROM g CROSS JOIN b), q AS (SELECT *, sqrt(dx * dx + dy * dy) AS off FROM d WHERE sqrt(dx * dx + dy * dy) <= 0.355),
h AS (SELECT source, gx, gy, n, region FROM q QUALIFY row_number() OVER (PARTITION BY source, gx, gy ORDER BY round(off, 9), region) = 1)
SELECT region AS geoid, sum(n)::BIGINT AS points, sum(CASE WHEN source = 'own' THEN n ELSE 0 END)::BIGINT AS own, sum(CASE WHEN source = 'extra' THEN n ELSE 0 END)::BIGINT AS other, CASE WHEN 20 * sum(CASE WHEN source = 'extra' THEN n ELSE 0 END) < sum(n) THEN 'own' WHEN 20 * sum(CASE WHEN source = 'own' THEN n ELSE 0 END) < sum(n) THEN 'other' ELSE 'mixed' END AS origin FROM h GROUP BY region""")
def region_origin(spark, d):
    """Bins by source, placed in boxes or snapped to one within reach; no bin is just as far as that."""
    counties = shapes(spark, d).withColumnRenamed("name", "geoid")
    placed = coverage.placed_bins(coverage.binned(_two_sources(spark, d)), counties, 0.355)
    return coverage.county_summary(coverage.county_counts(placed), ["extra"]).select("geoid", "points", "own", "other", "origin")


def _weekly(spark, d):
    return read(spark, d, "events").groupBy(F.format_string("%05d", F.col("user_id") % 100).alias("geoid"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def _full_series(spark, d):
    """Every county on every day, zero included."""
    seen = _weekly(spark, d)
    days = sorted(row.day for row in seen.select("day").distinct().collect())  # some hundred
    return seen.select("geoid").distinct().select("geoid", F.explode(F.array(*map(F.lit, days))).alias("day")).join(seen, ["geoid", "day"], "left").fillna(0, ["n"])


_SERIES = """w AS (SELECT lpad((user_id % 100)::VARCHAR, 5, '0') AS geoid, ts::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL),
f AS (SELECT g.geoid, t.day, coalesce(n, 0)::BIGINT AS n FROM (SELECT DISTINCT geoid FROM w) g CROSS JOIN (SELECT DISTINCT day FROM w) t LEFT JOIN w ON w.geoid = g.geoid AND w.day = t.day), l AS (SELECT max(day) AS last FROM f)"""


@query(f"WITH {_SERIES} SELECT geoid, day, n, CASE WHEN day = last THEN 'layer' ELSE 'service' END AS source, CASE WHEN day = last THEN 'weekly' ELSE 'monthly' END AS \"interval\" FROM f, l")
def weekly_series_append(spark, d):
    series = _full_series(spark, d)
    last = series.agg(F.max("day")).first()[0]
    history = series.where(F.col("day") != last).select("geoid", "day", "n", F.lit("service").alias("source"), F.lit("monthly").alias("interval"))
    once = counts.append_counts(history, series.where(F.col("day") == last).select("geoid", (F.col("n") + 1).alias("n")), last, "layer")
    return counts.append_counts(once, series.where(F.col("day") == last).select("geoid", "n"), last, "layer")


@query(f"WITH {_SERIES} SELECT substr(geoid, 1, 4) AS state, day, sum(n)::BIGINT AS n FROM f GROUP BY ALL".replace("substr(geoid, 1, 4)", "substr(geoid, 1, 2)"))
def state_rollup(spark, d):
    return counts.state_series(_full_series(spark, d))


def _near_points(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(k.alias("id"), (k % 50).cast("string").alias("housenumber"), F.concat(F.col("c_mktsegment"), F.lit(" Street")).alias("street"), F.lit("Mesa").alias("city"), F.lit("85201").alias("postcode"), (-111.5 + (k * 7919 % 997) / F.lit(100000.0)).alias("lon"), (33.25 + (k * 104729 % 991) / F.lit(100000.0)).alias("lat"))
    other = rows.select("housenumber", F.when(F.col("id") % 3 == 0, F.upper("street")).when(F.col("id") % 3 == 1, F.concat(F.lit("North "), F.col("street"))).otherwise("Elsewhere").alias("street"), F.when(F.col("id") % 2 == 0, "Mesa").otherwise("Gilbert").alias("city"), F.lit("85201-1234").alias("postcode"), (F.col("lon") + 0.0002).alias("lon"), (F.col("lat") + 0.0001).alias("lat"))
    return rows, other


_NEAR = """p AS (SELECT c_custkey AS id, (c_custkey % 50)::VARCHAR AS num, lower(c_mktsegment) || ' street' AS st, -111.5 + (c_custkey * 7919 % 997) / 100000.0::DOUBLE AS lon, 33.25 + (c_custkey * 104729 % 991) / 100000.0::DOUBLE AS lat FROM customer),
m AS (SELECT num, CASE id % 3 WHEN 0 THEN st WHEN 1 THEN 'north ' || st ELSE 'elsewhere' END AS st, id % 2 = 0 AS same_city, lon + 0.0002 AS lon, lat + 0.0001 AS lat FROM p), f AS (SELECT num, st, min(id) AS id FROM p GROUP BY ALL),
c AS (SELECT f.id, f.num, f.st, m.st AS mst, m.same_city, 111320.0::DOUBLE * sqrt((m.lat - p.lat) * (m.lat - p.lat) + ((m.lon - p.lon) * cos(radians(p.lat))) * ((m.lon - p.lon) * cos(radians(p.lat)))) AS off FROM f JOIN p USING (id) JOIN m ON m.num = f.num),
k AS (SELECT *, CASE WHEN mst = st THEN 0 WHEN mst = 'north ' || st THEN 1 ELSE 2 END AS kind FROM c WHERE off <= 100), b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY kind, off) = 1)"""


@query(f"WITH {_NEAR} SELECT f.id::BIGINT AS id, CASE kind WHEN 0 THEN 'matched' WHEN 1 THEN 'matched_directional_differs' WHEN 2 THEN 'street_conflict' ELSE 'not_in_osm' END AS outcome, round(off, 4) AS metres_off, coalesce(kind < 2 AND NOT same_city, false) AS city_differs FROM f LEFT JOIN b USING (id)")
def nearest_name_match(spark, d):
    points, mapped = _near_points(spark, d)
    return review.address_matches(points, mapped).select("id", "outcome", "metres_off", "city_differs")


@query("""WITH s AS (SELECT p_name || CASE p_partkey % 2 WHEN 0 THEN '' ELSE ' Way' END AS street, count(*)::BIGINT AS n FROM part GROUP BY ALL), w AS (SELECT street, n, string_split(street, ' ')[1] AS a, replace(street, ' Way', '') AS core, street LIKE '% Way' AS way FROM s)
SELECT street, n, CASE WHEN way THEN CASE a WHEN 'small' THEN 'exact' WHEN 'red' THEN 'case_only' WHEN 'blue' THEN 'punctuation_only' WHEN 'large' THEN 'directional_only' ELSE 'unmatched' END ELSE CASE a WHEN 'green' THEN 'alternate' ELSE 'unmatched' END END AS how FROM w""")
def street_name_match(spark, d):
    way = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "").otherwise(" Way"))
    points = read(spark, d, "part").select(way.alias("street"))
    names = read(spark, d, "part").select("p_name").distinct().withColumn("a", F.element_at(F.split("p_name", " "), 1))
    full = F.concat("p_name", F.lit(" Way"))
    made = F.when(F.col("a") == "small", full).when(F.col("a") == "red", F.upper(full)).when(F.col("a") == "blue", F.replace(full, F.lit(" "), F.lit("-"))).when(F.col("a") == "large", F.concat(F.lit("North "), full)).when(F.col("a") == "green", F.col("p_name"))
    return review.street_matches(points, names.select(made.alias("name"), (F.col("a") == "green").alias("alternate"))).select("street", "n", "how")


def _points(spark, d, city, zip_code, state=None):
    """Customers as tagged points; city, zip_code and state are columns."""
    state = F.when(F.col("c_nationkey") % 2 == 0, "KS").otherwise("NY") if state is None else state
    rows = located(read(spark, d, "customer"), "c_custkey")
    return rows.select(
        F.col("c_custkey").cast("string").alias("nad_oid"), "lon", "lat", F.col("c_custkey").cast("string").alias("addr_housenumber"), F.col("c_mktsegment").alias("addr_street"), city.alias("addr_city"),
        state.alias("addr_state"), zip_code.alias("addr_postcode"), F.lit("Pratt").alias("county"), F.lit("Site").alias("placement"),
        F.lit("2024-01-01").alias("date_update"), F.when(city.isNull(), F.array(F.lit("no_city"))).otherwise(F.array(F.lit("city_not_in_reference"))).alias("flags"), F.when(F.col("c_custkey") % 10 == 9, "duplicate").alias("drop_reason"),
    )


def _state_shapes(spark, d, grow, tall):
    """Each box once for either state."""
    return shapes(spark, d, grow, tall).withColumn("state", F.explode(F.array(F.lit("KS"), F.lit("NY"))))


@query(f"""WITH c AS (SELECT c_custkey, {place('c_custkey')}, CASE WHEN c_custkey % 3 = 0 THEN 'Mesa' END AS city, CASE WHEN c_nationkey % 2 = 0 THEN 'KS' ELSE 'NY' END AS st, CASE WHEN c_custkey % 4 < 2 THEN (c_nationkey)::VARCHAR END AS zip, c_custkey % 10 <> 9 AS kept FROM customer), b AS ({BOX}),
p AS (SELECT c_custkey, min(region) AS p FROM c JOIN b ON lon > x AND lon < x + 4.0 AND lat > y AND lat < y + 3.0 GROUP BY 1), t AS (SELECT c_custkey, min(region) AS t FROM c JOIN b ON lon > x AND lon < x + 9.0 AND lat > y AND lat < y + 4.0 GROUP BY 1),
j AS (SELECT c.*, CASE WHEN kept AND city IS NULL AND zip IN ('1', '2', '3') THEN 'Wellsford' END AS fz, CASE WHEN kept AND city IS NULL THEN p END AS fp, CASE WHEN kept AND city IS NULL AND st = 'NY' THEN t END AS ft, CASE WHEN kept AND zip IS NULL THEN t END AS fa FROM c LEFT JOIN p USING (c_custkey) LEFT JOIN t USING (c_custkey))
SELECT c_custkey::VARCHAR AS nad_oid, coalesce(city, fz, fp, ft) AS addr_city, coalesce(zip, fa) AS addr_postcode, array_to_string(list_sort(list_filter([CASE WHEN city IS NOT NULL THEN 'city_not_in_reference' WHEN coalesce(fz, fp, ft) IS NULL THEN 'no_city' END, CASE WHEN city IS NOT NULL THEN NULL WHEN fz IS NOT NULL THEN 'city_from_zip' WHEN fp IS NOT NULL THEN 'city_from_census_place' WHEN ft IS NOT NULL THEN 'city_from_census_cousub' END, CASE WHEN zip IS NULL AND fa IS NOT NULL THEN 'postcode_from_zcta' END], lambda x: x IS NOT NULL)), ',') AS flags FROM j""")
def filled_points(spark, d):
    k = F.col("c_custkey")
    points = _points(spark, d, F.when(k % 3 == 0, "Mesa"), F.when(k % 4 < 2, F.col("c_nationkey").cast("string")))
    facts = spark.createDataFrame([(s, z, "Wellsford") for s in ("KS", "NY") for z in ("1", "2", "3")], "state string, zip string, city string")
    filled = filling.backfill(points, _state_shapes(spark, d, 4.0, 3.0), _state_shapes(spark, d, 9.0, 4.0), shapes(spark, d), facts)
    return filled.select("nad_oid", "addr_city", "addr_postcode", F.array_join("flags", ",").alias("flags"))


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Mesa' END AS city, CASE WHEN c_nationkey % 2 = 0 THEN 'KS' ELSE 'NY' END AS st, c_custkey % 10 <> 9 AS kept FROM customer), f AS (SELECT *, CASE WHEN kept AND city IS NULL AND st = 'KS' THEN CASE c_custkey % 4 WHEN 0 THEN 'Wellsford' WHEN 1 THEN 'La Crosse' END END AS found FROM c)
SELECT c_custkey::VARCHAR AS nad_oid, coalesce(city, found) AS addr_city, CASE WHEN found IS NOT NULL THEN 'city_from_source_msag' WHEN city IS NULL THEN 'no_city' ELSE 'city_not_in_reference' END AS flags FROM f""")
def supplemented_points(spark, d):
    """Each point has a community of its number beside it: known places for half of them, and a farther one that loses."""
    k = F.col("c_custkey")
    points = _points(spark, d, F.when(k % 3 == 0, "Mesa"), F.lit(None).cast("string"))
    around = located(read(spark, d, "customer"), "c_custkey").select(F.lit("KS").alias("state"), k.cast("string").alias("number"), F.when(k % 4 == 0, "WELLSFORD").when(k % 4 == 1, "LACROSSE").otherwise("Sunny Acres").alias("community"), F.col("lon") + 0.0003, F.col("lat") - 0.0004).toDF("state", "number", "community", "lon", "lat")
    farther = around.select("state", "number", F.lit("La Crosse").alias("community"), F.col("lon") + 0.0004, "lat").toDF("state", "number", "community", "lon", "lat")
    communities = around.unionByName(farther)
    known = known_places(spark)
    filled = filling.supplement(points, filling.community_matches(points, communities), filling.community_cities(communities, known))
    return filled.select("nad_oid", "addr_city", F.array_join("flags", ",").alias("flags"))


@query("""WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'Reno' ELSE 'RENO County' END AS county, o_custkey % 150 AS num, CASE WHEN o_orderkey % 3 = 0 THEN 'Mesa' END AS city, CASE o_orderkey % 5 WHEN 0 THEN 'Structure - Roof' WHEN 1 THEN 'Site' WHEN 2 THEN 'Parcel' WHEN 3 THEN NULL ELSE 'Linear Geocode' END AS pl, CASE WHEN o_orderkey % 4 <> 0 THEN '2024-0' || (o_orderkey % 3 + 1)::VARCHAR END AS upd, -97.5 + (o_orderkey % 4) * 0.0005 AS lon, 38.25 + (o_orderkey % 6 // 5) * 0.01 AS lat FROM orders WHERE o_orderkey % 13 <> 0),
r AS (SELECT *, CASE WHEN pl LIKE 'Struct%' THEN 1 WHEN pl = 'Site' THEN 2 WHEN pl = 'Parcel' THEN 3 WHEN pl = 'Linear Geocode' THEN 5 ELSE 4 END AS rk FROM o),
a AS (SELECT *, row_number() OVER w AS pos, first_value(lat) OVER w AS bl, first_value(lon) OVER w AS bo FROM r WINDOW w AS (PARTITION BY num ORDER BY rk, upd DESC NULLS LAST, id)), d1 AS (SELECT *, pos > 1 AND 111320.0::DOUBLE * sqrt((lat - bl) * (lat - bl) + ((lon - bo) * cos(radians(bl))) * ((lon - bo) * cos(radians(bl)))) <= 100 AS dup FROM a),
b AS (SELECT id, lat, lon, num, city, row_number() OVER w AS pos, first_value(lat) OVER w AS bl, first_value(lon) OVER w AS bo FROM d1 WHERE NOT dup WINDOW w AS (PARTITION BY num, lower(coalesce(city, '')) ORDER BY rk, upd DESC NULLS LAST, id)), m AS (SELECT *, 111320.0::DOUBLE * sqrt((lat - bl) * (lat - bl) + ((lon - bo) * cos(radians(bl))) * ((lon - bo) * cos(radians(bl)))) AS off FROM b),
e AS (SELECT id, pos > 1 AND off <= 100 AS dup2, bool_or(off > 100) OVER (PARTITION BY num, lower(coalesce(city, ''))) AS far FROM m)
SELECT o_orderkey::VARCHAR AS nad_oid, CASE WHEN o_orderkey % 13 = 0 THEN 'inactive_lifecycle' WHEN e.id IS NULL OR dup2 THEN 'duplicate' END AS drop_reason, coalesce(far AND NOT dup2, false) AS elsewhere FROM orders LEFT JOIN e ON e.id = o_orderkey""")
def deduplicated_points(spark, d):
    k = F.col("o_orderkey")
    points = read(spark, d, "orders").select(
        k.cast("string").alias("nad_oid"), (-97.5 + (k % 4) * 0.0005).alias("lon"), (38.25 + F.floor(k % 6 / 5) * 0.01).alias("lat"), F.lit("KS").alias("addr_state"), F.when(k % 2 == 0, "Reno").otherwise("RENO County").alias("county"),
        (F.col("o_custkey") % 150).cast("string").alias("addr_housenumber"), F.lit("Oak Street").alias("addr_street"), F.lit(None).cast("string").alias("addr_unit"), F.when(k % 3 == 0, "Mesa").alias("addr_city"),
        F.when(k % 5 == 0, "Structure - Roof").when(k % 5 == 1, "Site").when(k % 5 == 2, "Parcel").when(k % 5 == 4, "Linear Geocode").alias("placement"), F.when(k % 4 != 0, F.concat(F.lit("2024-0"), (k % 3 + 1).cast("string"))).alias("date_update"),
        F.array().cast(NOTHING).alias("flags"), F.when(k % 13 == 0, "inactive_lifecycle").alias("drop_reason"),
    )
    return deduplication.deduplicated(points).select("nad_oid", "drop_reason", F.array_contains("flags", "same_address_elsewhere").alias("elsewhere"))


def _layer(spark, d):
    """Customers twice as elements of a map layer, written in the order that lets row groups be skipped; every seventh has no house number."""
    rows = located(read(spark, d, "customer"), "c_custkey")
    box = F.struct(F.col("lon").alias("xmin"), F.col("lat").alias("ymin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymax"))
    elements = rows.select(F.explode(F.array(F.lit("node"), F.lit("way"))).alias("type"), F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 7 != 0, "1").alias("addr:housenumber"), F.timestamp_seconds(F.col("c_custkey") * 1000).alias("timestamp"), box.alias("bbox"))
    folder = shared_folder(spark, "layer")
    sinks.write_layer(elements, folder)
    return spark.read.parquet(folder)


_BOXES = {"west": (-121.0, 24.0, -100.0, 50.0), "east": (-100.0, 24.0, -65.0, 50.0)}


@query(f"""WITH c AS (SELECT c_custkey, {place('c_custkey')} FROM customer WHERE c_custkey % 7 <> 0), b AS ({BOX}), h AS (SELECT c_custkey, min(region) AS region FROM c JOIN b ON lon >= x AND lon <= x + 9.0 AND lat >= y AND lat <= y + 4.0 GROUP BY c_custkey)
SELECT n_name AS geoid, (2 * count(c_custkey))::BIGINT AS n FROM nation LEFT JOIN h ON region = n_name GROUP BY n_name""")
def layer_counts(spark, d):
    counties = shapes(spark, d).withColumnRenamed("name", "geoid")
    return counts.county_counts(counts.addresses_in_counties(_layer(spark, d), counties, _BOXES), counties)


@query(f"""SELECT region AS geoid FROM ({BOX}) WHERE NOT (x + 9.0 <= -100.0 OR (x >= -95.0 AND y + 4.0 <= 45.0))""")
def region_guard(spark, d):
    counties = shapes(spark, d).withColumnRenamed("name", "geoid")
    return counts.outside_regions(counties, {"west": (-121.0, 24.0, -100.0, 50.0), "east": (-95.0, 24.0, -65.0, 45.0)})


_TRIAGE = f"""k AS (SELECT c_custkey, {place('c_custkey')}, c_custkey * 7919 % 5000 // 1000 + 5 * (c_custkey * 104729 % 2400 // 480) AS g, c_custkey * 7919 % 5000 % 1000 BETWEEN 1 AND 399 AND c_custkey * 104729 % 2400 % 480 BETWEEN 1 AND 299 AS inner_part FROM customer WHERE c_custkey % 10 <> 9),
c AS (SELECT c_custkey, lon, lat, CASE WHEN g % 2 = 0 THEN 'KS' ELSE 'NY' END AS state, CASE WHEN c_custkey % 6 < 2 THEN 'NATON_' || g::VARCHAR WHEN c_custkey % 6 = 2 THEN 'OTHER_' || g::VARCHAR WHEN NOT inner_part THEN 'FAR_' || g::VARCHAR WHEN c_custkey % 6 = 3 THEN 'NAION_' || g::VARCHAR WHEN c_custkey % 6 = 4 THEN 'INNER_' || g::VARCHAR ELSE 'TRIO_' || (g // 6)::VARCHAR END AS city FROM k), b AS ({BOX}),
i AS (SELECT c_custkey, min(CASE WHEN lon < x + 4.0 AND lat < y + 3.0 THEN region END) AS p, min(region) AS t FROM c JOIN b ON lon > x AND lon < x + 9.0 AND lat > y AND lat < y + 4.0 GROUP BY 1), j AS (SELECT c.*, p, t FROM c LEFT JOIN i USING (c_custkey)),
n AS (SELECT state, city, count(*) AS n, count(p) AS np FROM j GROUP BY ALL),
q AS (SELECT state, city, p, count(*) AS kp FROM j WHERE p IS NOT NULL GROUP BY state, city, p QUALIFY row_number() OVER (PARTITION BY state, city ORDER BY count(*) DESC, p) = 1),
u AS (SELECT state, city, t, count(*) AS kt FROM j WHERE t IS NOT NULL GROUP BY state, city, t QUALIFY row_number() OVER (PARTITION BY state, city ORDER BY count(*) DESC, t) = 1),
a AS (SELECT *, damerau_levenshtein(lower(city), lower(p)) <= CASE WHEN length(city) >= 8 THEN 2 ELSE 1 END OR (city[1 : 3] = p[1 : 3] AND regexp_matches(lower(p), regexp_replace(lower(city), '(.)', '\\1.*', 'g'))) AS like_p, damerau_levenshtein(lower(city), lower(t)) <= CASE WHEN length(city) >= 8 THEN 2 ELSE 1 END OR (city[1 : 3] = t[1 : 3] AND regexp_matches(lower(t), regexp_replace(lower(city), '(.)', '\\1.*', 'g'))) AS like_t, kp >= 0.5 * n AS in_p, kt >= 0.5 * n AS in_t FROM n LEFT JOIN q USING (state, city) LEFT JOIN u USING (state, city))"""


@query(f"""WITH {_TRIAGE} SELECT state, city, n::BIGINT AS n, CASE WHEN like_p AND in_p THEN 'correction_place' WHEN like_t AND in_t THEN 'correction_cousub' WHEN in_p THEN 'differs_from_place' WHEN np >= 0.5 * n THEN 'split_across_places' ELSE 'outside_places' END AS bucket, p AS top_place, t AS top_town FROM a""")
def triage_buckets(spark, d):
    """Unknown cities by the cell they lie in: misspelled names of it all over the cell or in its inner part alone, other names, and one name in several cells."""
    k = F.col("c_custkey")
    x, y = k * 7919 % 5000, k * 104729 % 2400
    g = F.floor(x / 1000) + 5 * F.floor(y / 480)
    inner = (x % 1000).between(1, 399) & (y % 480).between(1, 299)
    named = lambda word, number: F.concat(F.lit(word), number.cast("string"))
    city = F.when(k % 6 < 2, named("NATON_", g)).when(k % 6 == 2, named("OTHER_", g)).when(~inner, named("FAR_", g)).when(k % 6 == 3, named("NAION_", g)).when(k % 6 == 4, named("INNER_", g)).otherwise(named("TRIO_", F.floor(g / 6)))
    points = _points(spark, d, city, F.lit(None).cast("string"), F.when(g % 2 == 0, "KS").otherwise("NY"))
    found = review.city_triage(points, _state_shapes(spark, d, 4.0, 3.0), _state_shapes(spark, d, 9.0, 4.0), shapes(spark, d), known_places(spark))
    return found.select("state", "city", "n", "bucket", "top_place", "top_town")


@query()
def typo_candidates(spark, d):
    """Misspelled cities on streets that known cities share; see tests/test_stages.py for what must come out."""
    k = F.col("c_custkey")
    unknown = _points(spark, d, F.when(k % 5 == 0, "Welsford").when(k % 5 == 1, "Jonahh"), F.lit("67001"))
    known = _points(spark, d, F.when(k % 5 > 1, "Wellsford"), F.lit("67001")).withColumn("flags", F.array().cast(NOTHING))
    points = unknown.unionByName(known).where("addr_city is not null")
    hamlets = spark.createDataFrame([("KS", "Jonah", -97.0, 38.0)], "state string, name string, lon double, lat double")
    return review.typo_candidates(points, _state_shapes(spark, d, 4.0, 3.0), hamlets, known_places(spark))


@query("""SELECT n_name AS geoid, 5::BIGINT AS n_points, 4.0::DOUBLE AS area, 2.0::DOUBLE * (n_nationkey % 5) AS west, 2.0::DOUBLE * (n_nationkey // 5) AS south FROM nation""")
def simplified_borders(spark, d):
    """Squares side by side whose common borders have a point a little off: each side loses the same one, and they stay squares."""
    k = F.col("n_nationkey")
    x, y = 2.0 * (k % 5), 2.0 * F.floor(k / 5)
    p = lambda px, py: F.struct(px.cast("double").alias("x"), py.cast("double").alias("y"))
    ring = F.array(p(x, y), p(x + 1, y + 0.001), p(x + 2, y), p(x + 2.001, y + 1), p(x + 2, y + 2), p(x + 1, y + 2.001), p(x, y + 2), p(x + 0.001, y + 1), p(x, y))
    made = coverage.simplified_shapes(read(spark, d, "nation").select(F.col("n_name").alias("geoid"), F.array(ring).alias("rings")), 0.05, 0.0001)
    own = made.select("geoid", F.col("rings")[0].alias("r"))
    area = F.expr("abs(aggregate(sequence(0, size(r) - 2), 0D, (a, i) -> a + r[i].x * r[i + 1].y - r[i + 1].x * r[i].y)) / 2")
    least = lambda c: F.array_min(F.transform("r", lambda q: q[c]))
    return own.select("geoid", F.size("r").cast("long").alias("n_points"), area.alias("area"), least("x").alias("west"), least("y").alias("south"))
