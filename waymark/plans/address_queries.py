"""Driver-facing queries of the address engine on the supplied tables, with their SQL.

Positions are derived from integer keys; regions are the 25 boxes of a 5 by 5 grid, one for each nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions import columns as C
from waymark.functions import rules as R
from waymark.operators import duplicates, profiling, spatial
from waymark.operators.memo import apply_rule

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def located(rows: DataFrame, key: str) -> DataFrame:
    k = F.col(key)
    return rows.withColumns({"lon": -120 + (k * 7919 % 5000) / F.lit(100.0), "lat": 25 + (k * 104729 % 2400) / F.lit(100.0)})


def place(key: str) -> str:
    return f"-120 + ({key} * 7919 % 5000) / 100.0::DOUBLE AS lon, 25 + ({key} * 104729 % 2400) / 100.0::DOUBLE AS lat"


def boxes(nation: DataFrame, grow: float = 10.0, tall: float = 4.8) -> DataFrame:
    """A box for each nation: gaps between them where grow or tall is less than the grid's step."""
    k = F.col("n_nationkey")
    x, y = -120.0 + (k % 5) * 10.0, 25.0 + F.floor(k / 5) * 4.8
    p = lambda px, py: F.struct(px.cast("double").alias("x"), py.cast("double").alias("y"))
    ring = F.array(p(x, y), p(x + grow, y), p(x + grow, y + tall), p(x, y + tall), p(x, y))
    return nation.select(F.col("n_name").alias("region"), F.array(ring).alias("rings"))


BOX = "SELECT n_name AS region, -120.0::DOUBLE + (n_nationkey % 5) * 10.0::DOUBLE AS x, 25.0::DOUBLE + (n_nationkey // 5) * 4.8::DOUBLE AS y FROM nation"


@query("""SELECT event_type, count(*)::BIGINT AS n_rows, round(100.0::DOUBLE * count(nullif(trim(CASE WHEN user_id % 5 = 0 THEN '  ' ELSE props END), '')) / count(*), 1) AS p_filled,
round(100.0::DOUBLE * count(CASE WHEN value > 50 THEN 1 END) / count(*), 1) AS v_filled FROM events GROUP BY event_type""")
def fill_rates(spark, d):
    rows = read(spark, d, "events").select("event_type", F.when(F.col("user_id") % 5 == 0, "  ").otherwise(F.col("props")).alias("p"), F.when(F.col("value") > 50, F.col("value")).alias("v"))
    return profiling.fill_rates(rows, "event_type", ["p", "v"])


@query("""WITH u AS (SELECT p_type, 'p_brand' AS col, p_brand AS val FROM part UNION ALL SELECT p_type, 'p_size', p_size::VARCHAR FROM part),
c AS (SELECT p_type, col, val, count(*)::BIGINT AS n FROM u WHERE val IS NOT NULL GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY p_type, col ORDER BY n DESC, val)::BIGINT AS place FROM c QUALIFY place <= 20""")
def top_values(spark, d):
    return profiling.top_values(read(spark, d, "part"), "p_type", ["p_brand", "p_size"], 20)


@query("""WITH t AS (SELECT string_split(lower(trim(p_name)), ' ') AS t FROM part), e AS (SELECT 'first' AS place, t[1] AS token FROM t UNION ALL SELECT 'last', t[-1] FROM t)
SELECT place, token, count(*)::BIGINT AS n FROM e GROUP BY ALL HAVING count(*) >= 20""")
def token_profile(spark, d):
    return profiling.end_tokens(read(spark, d, "part"), "p_name", 20)


@query("""SELECT l_returnflag, count(*)::BIGINT AS n_rows, (count(*) - count(DISTINCT (l_orderkey, nullif(l_partkey % 7, 0))))::BIGINT AS n_repeats, count(*) FILTER (WHERE l_discount > 0.05)::BIGINT AS n_discounted,
count(*) FILTER (WHERE regexp_matches(l_partkey::VARCHAR, '^[0-9]{2}$'))::BIGINT AS n_short, min(l_suppkey)::BIGINT AS low, max(l_suppkey)::BIGINT AS high, count(DISTINCT l_suppkey)::BIGINT AS n_suppliers FROM lineitem GROUP BY l_returnflag""")
def quality_metrics(spark, d):
    rows = read(spark, d, "lineitem").withColumn("pair", F.struct("l_orderkey", F.nullif(F.col("l_partkey") % 7, F.lit(0)).alias("part")))
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("l_discount") > 0.05).alias("n_discounted"), F.count_if(F.col("l_partkey").cast("string").rlike(r"\A[0-9]{2}\z")).alias("n_short"), F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high")]
    of_pairs = rows.groupBy("l_returnflag", "pair").agg(*counts).groupBy("l_returnflag").agg(F.sum("n_rows").alias("n_rows"), (F.sum("n_rows") - F.count(F.lit(1))).alias("n_repeats"), F.sum("n_discounted").alias("n_discounted"), F.sum("n_short").alias("n_short"), F.min("low").alias("low"), F.max("high").alias("high"))
    suppliers = rows.select("l_returnflag", "l_suppkey").distinct().groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_suppliers"))
    return of_pairs.join(suppliers, "l_returnflag")


@query("""SELECT event_type, count(*) FILTER (WHERE TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) IS NULL)::BIGINT AS bad, sum(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT))::BIGINT AS total FROM events GROUP BY event_type""")
def bad_cast_counts(spark, d):
    k = C.whole_number(F.regexp_extract("props", "([0-9]+)", 1))
    return read(spark, d, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count_if(F.col("k").isNull()).alias("bad"), F.sum("k").alias("total"))


@query("""SELECT c_name AS name, c_nationkey::BIGINT AS nation, c_mktsegment AS segment, 'customer' AS origin FROM customer UNION ALL SELECT s_name, s_nationkey::BIGINT, NULL, 'supplier' FROM supplier""")
def multi_source_union(spark, d):
    a = read(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("long").alias("nation"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("origin"))
    b = read(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("long").alias("nation"), F.lit("supplier").alias("origin"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""WITH r AS (SELECT c_custkey, c_mktsegment AS kind, c_nationkey, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS copy FROM customer), m AS (SELECT *, upper(md5(concat_ws('|', kind, c_nationkey::VARCHAR, copy::VARCHAR))) AS h FROM r)
SELECT c_custkey::BIGINT AS c_custkey, substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) AS row_uuid FROM m""")
def mapped_source_ids(spark, d):
    copy = F.row_number().over(Window.partitionBy("c_mktsegment", "c_nationkey").orderBy("c_custkey"))
    rows = read(spark, d, "customer").withColumn("copy", copy)
    return rows.select("c_custkey", C.uuid_from(F.concat_ws("|", "c_mktsegment", F.col("c_nationkey").cast("string"), F.col("copy").cast("string"))).alias("row_uuid"))


@query("""SELECT p_partkey::BIGINT AS p_partkey, coalesce(nullif(p_type, 'PROMO'), 'none') || '/' || coalesce(nullif(p_size % 7, 0)::VARCHAR, 'none') AS label FROM part""")
def memo_rule_join(spark, d):
    rows = read(spark, d, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("kind"), F.nullif(F.col("p_size") % 7, F.lit(0)).alias("size"))
    rule = lambda kind, size: F.concat(F.coalesce(kind, F.lit("none")), F.lit("/"), F.coalesce(size.cast("string"), F.lit("none")))
    return apply_rule(rows, ["kind", "size"], rule, "label").select("p_partkey", "label")


@query("""WITH f AS (SELECT list_sort(list_distinct(list_filter([CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderstatus = 'F' THEN 'closed' END, CASE WHEN o_custkey % 3 = 0 THEN 'third' END], lambda x: x IS NOT NULL))) AS fl FROM orders)
SELECT flag, count(*)::BIGINT AS n FROM (SELECT unnest(fl) AS flag FROM f) GROUP BY flag""")
def flag_explosion(spark, d):
    made = C.flags((F.col("o_totalprice") > 200000, "large"), (F.col("o_orderstatus") == "F", "closed"), (F.col("o_custkey") % 3 == 0, "third"))
    return read(spark, d, "orders").select(F.explode(made).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH a AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'N' WHEN 1 THEN '89-' WHEN 2 THEN 'Milepost' WHEN 3 THEN 'BILLBD' END AS p, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '000' ELSE (o_custkey)::VARCHAR END AS n,
CASE o_orderkey % 5 WHEN 0 THEN 'b' WHEN 1 THEN 'LOT' WHEN 2 THEN '.5' WHEN 3 THEN 'BLK' END AS s FROM orders),
b AS (SELECT *, CASE WHEN n IS NULL THEN 'no_housenumber' WHEN p = 'Milepost' THEN 'milepost_address' WHEN s = 'BLK' THEN 'block_address' WHEN p = 'BILLBD' THEN 'unparsed_housenumber' WHEN p IS NULL AND ltrim(n, '0') = '' AND (s IS NULL OR s <> '.5') THEN 'zero_housenumber' END AS drop_reason,
CASE WHEN ltrim(n, '0') = '' THEN '0' ELSE ltrim(n, '0') END AS z FROM a)
SELECT o_orderkey::BIGINT AS o_orderkey, drop_reason, CASE WHEN drop_reason IS NULL THEN coalesce(p, '') || CASE WHEN p = '89-' AND length(z) < 2 THEN '0' || z ELSE z END || CASE WHEN s = 'b' THEN ' B' WHEN s = '.5' THEN '.5' ELSE '' END END AS value FROM b""")
def housenumber_rule(spark, d):
    pick = lambda key, n, *values: F.element_at(F.array(*(F.lit(v) for v in values)), (F.col(key) % n + 1).cast("int"))
    rows = read(spark, d, "orders").select("o_orderkey", pick("o_orderkey", 7, "N", "89-", "Milepost", "BILLBD", None, None, None).alias("p"), F.when(F.col("o_orderkey") % 11 == 0, None).when(F.col("o_orderkey") % 13 == 0, "000").otherwise(F.col("o_custkey").cast("string")).alias("n"), pick("o_orderkey", 5, "b", "LOT", ".5", "BLK", None).alias("s"))
    return rows.select("o_orderkey", R.housenumber(F.col("p"), F.col("n"), F.col("s")).alias("r")).select("o_orderkey", "r.drop_reason", "r.value")


@query("""WITH a AS (SELECT c_custkey, (c_custkey * 37 % 100000)::VARCHAR AS z, CASE WHEN c_nationkey % 2 = 0 THEN 'MA' ELSE 'TX' END AS st FROM customer)
SELECT c_custkey::BIGINT AS c_custkey, CASE WHEN length(z) = 5 AND z BETWEEN '00501' AND '99950' THEN z WHEN length(z) = 4 AND st = 'MA' AND ltrim(z, '0') <> '' THEN '0' || z END AS value,
CASE WHEN (length(z) = 5 AND z BETWEEN '00501' AND '99950') OR ltrim(z, '0') = '' THEN '' WHEN length(z) = 4 AND st = 'MA' THEN 'postcode_zero_restored' ELSE 'bad_postcode' END AS flags FROM a""")
def postcode_rule(spark, d):
    rows = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * 37 % 100000).cast("string").alias("z"), F.when(F.col("c_nationkey") % 2 == 0, "MA").otherwise("TX").alias("st"))
    return rows.select("c_custkey", R.postcode(F.col("z"), F.col("st")).alias("r")).select("c_custkey", "r.value", F.array_join("r.flags", ",").alias("flags"))


@query("""SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'inactive_lifecycle' END AS drop_reason, count(*)::BIGINT AS n FROM orders GROUP BY ALL""")
def lifecycle_rule(spark, d):
    state = F.when(F.col("o_orderstatus") == "F", " Retired ").otherwise("Active")
    return read(spark, d, "orders").select("o_orderstatus", R.lifecycle_drop(state).alias("drop_reason")).groupBy("o_orderstatus", "drop_reason").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH v AS (SELECT p_type, lower(string_split(p_name, ' ')[-1]) AS key, p_name, count(*)::BIGINT AS n FROM part GROUP BY ALL)
SELECT p_type, key, p_name, n FROM v QUALIFY row_number() OVER (PARTITION BY p_type, key ORDER BY n DESC, p_name) = 1""")
def place_vote(spark, d):
    votes = read(spark, d, "part").groupBy("p_type", F.lower(F.element_at(F.split("p_name", " "), -1)).alias("key"), "p_name").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("p_type", "key").agg(F.min(F.struct(F.negative("n").alias("m"), "p_name", "n")).alias("b"))
    return best.select("p_type", "key", "b.p_name", "b.n")


@query("""WITH a AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS city FROM customer)
SELECT c_custkey::BIGINT AS c_custkey, coalesce(city, n_name, 'none') AS city, CASE WHEN city IS NULL AND n_name IS NOT NULL THEN 'city_from_zip' ELSE '' END AS flags FROM a LEFT JOIN (SELECT n_nationkey, CASE WHEN n_nationkey % 4 <> 1 THEN n_name END AS n_name FROM nation) n ON n_nationkey = c_nationkey""")
def coalesce_fill(spark, d):
    facts = read(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 4 != 1, F.col("n_name")).alias("n_name"))
    rows = read(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("city"))
    own = rows.join(facts, rows.c_nationkey == facts.n_nationkey, "left")
    return own.select("c_custkey", F.coalesce("city", "n_name", F.lit("none")).alias("city"), F.array_join(C.flags((F.col("city").isNull() & F.col("n_name").isNotNull(), "city_from_zip")), ",").alias("flags"))


@query(f"""WITH c AS (SELECT c_custkey, {place('c_custkey')} FROM customer), b AS ({BOX})
SELECT c_custkey::BIGINT AS c_custkey, min(region) AS region FROM c JOIN b ON lon > x AND lon < x + 9.0 AND lat > y AND lat < y + 4.0 GROUP BY c_custkey""")
def point_in_region(spark, d):
    return spatial.points_in_polygons(located(read(spark, d, "customer"), "c_custkey"), boxes(read(spark, d, "nation"), 9.0, 4.0), "c_custkey", "region")


@query(f"""WITH c AS (SELECT c_custkey, {place('c_custkey')} FROM customer), b AS ({BOX})
SELECT c_custkey::BIGINT AS c_custkey, min(region) AS region FROM c JOIN b ON lon >= x AND lon <= x + 10.0 AND lat >= y AND lat <= y + 4.0 GROUP BY c_custkey""")
def point_on_edge_once(spark, d):
    return spatial.points_in_polygons(located(read(spark, d, "customer"), "c_custkey"), boxes(read(spark, d, "nation"), 10.0, 4.0), "c_custkey", "region", boundary=True)


@query(f"""WITH s AS (SELECT s_suppkey, {place('s_suppkey')} FROM supplier), b AS ({BOX}), p AS (SELECT s_suppkey, region, greatest(x - lon, 0.0, lon - x - 8.0) AS dx, greatest(y - lat, 0.0, lat - y - 3.0) AS dy FROM s CROSS JOIN b),
o AS (SELECT s_suppkey FROM p GROUP BY s_suppkey HAVING min(dx * dx + dy * dy) > 0), q AS (SELECT s_suppkey, region, sqrt(dx * dx + dy * dy) AS dist FROM p JOIN o USING (s_suppkey))
SELECT s_suppkey::BIGINT AS s_suppkey, region, round(dist, 6) AS distance FROM q WHERE dist <= 2.0 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY dist, region) = 1""")
def snap_to_nearest(spark, d):
    points, shapes = located(read(spark, d, "supplier"), "s_suppkey"), boxes(read(spark, d, "nation"), 8.0, 3.0)
    inside = spatial.points_in_polygons(points, shapes, "s_suppkey", "region", boundary=True)
    outside = points.join(inside.select("s_suppkey"), "s_suppkey", "left_anti")
    return spatial.nearest_polygon(outside, shapes, "s_suppkey", "region", 2.0).withColumn("distance", F.round("distance", 6))


@query(f"""WITH c AS (SELECT c_custkey, c_nationkey, {place('c_custkey')} FROM customer), s AS (SELECT s_suppkey, s_name, {place('s_suppkey * 3')} FROM supplier),
p AS (SELECT c_custkey, s_name, abs(s.lat - c.lat) + abs(s.lon - c.lon) AS far FROM c JOIN s ON abs(s.lat - c.lat) <= 0.5 AND abs(s.lon - c.lon) * cos(radians(c.lat)) <= 0.4)
SELECT c_custkey::BIGINT AS c_custkey, s_name FROM p QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY round(far, 6), s_name) = 1""")
def grid_proximity_fill(spark, d):
    a = located(read(spark, d, "customer"), "c_custkey").select("c_custkey", "lon", "lat")
    b = located(read(spark, d, "supplier").withColumn("k", F.col("s_suppkey") * 3), "k").select("s_name", "lon", "lat")
    pairs = spatial.neighbours(a, b, 1.0)
    dlat, dlon = F.abs(F.col("lat2") - F.col("lat")), F.abs(F.col("lon2") - F.col("lon"))
    near = pairs.where((dlat <= 0.5) & (dlon * F.cos(F.radians("lat")) <= 0.4)).select("c_custkey", "s_name", F.round(dlat + dlon, 6).alias("far"))
    return near.groupBy("c_custkey").agg(F.min(F.struct("far", "s_name")).alias("b")).select("c_custkey", "b.s_name")


@query(f"""WITH c AS (SELECT c_custkey, c_nationkey, {place('c_custkey')} FROM customer), s AS (SELECT s_suppkey, s_nationkey, {place('s_suppkey * 3')} FROM supplier),
p AS (SELECT s_suppkey, c_custkey, 111.2::DOUBLE * sqrt((c.lat - s.lat) * (c.lat - s.lat) + ((c.lon - s.lon) * cos(radians(s.lat))) * ((c.lon - s.lon) * cos(radians(s.lat)))) AS km FROM s JOIN c ON c_nationkey = s_nationkey)
SELECT s_suppkey::BIGINT AS s_suppkey, c_custkey::BIGINT AS c_custkey, round(km, 4) AS km FROM p WHERE km <= 250""")
def band_candidates(spark, d):
    a = located(read(spark, d, "supplier").withColumn("k", F.col("s_suppkey") * 3), "k").select("s_suppkey", F.col("s_nationkey").alias("nation"), "lon", "lat")
    b = located(read(spark, d, "customer"), "c_custkey").select("c_custkey", F.col("c_nationkey").alias("nation"), "lon", "lat")
    pairs = spatial.neighbours(a, b, 4.0, ["nation"])
    km = C.kilometres(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return pairs.where(km <= 250).select("s_suppkey", "c_custkey", F.round(km, 4).alias("km"))


@query(f"""WITH c AS (SELECT c_mktsegment, {place('c_custkey')} FROM customer)
SELECT c_mktsegment, round(lon)::INT::BIGINT AS gx, round(lat)::INT::BIGINT AS gy, count(*)::BIGINT AS n, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat FROM c GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY c_mktsegment, round(c.lon), round(c.lat)"))
def grid_bins(spark, d):
    rows = located(read(spark, d, "customer"), "c_custkey")
    return rows.groupBy("c_mktsegment", F.round("lon").cast("long").alias("gx"), F.round("lat").cast("long").alias("gy")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("lon"), 6).alias("lon"), F.round(F.avg("lat"), 6).alias("lat"))


@query(f"""WITH p AS (SELECT 'c' AS src, {place('c_custkey')} FROM customer UNION ALL SELECT 's', {place('s_suppkey * 3')} FROM supplier), b AS ({BOX}),
h AS (SELECT region, count(*) FILTER (WHERE src = 'c') AS own, count(*) FILTER (WHERE src = 's') AS other FROM b JOIN p ON lon > x AND lon < x + 9.0 AND lat > y AND lat < y + 4.0 GROUP BY region)
SELECT n_name AS region, coalesce(own, 0)::BIGINT AS own, coalesce(other, 0)::BIGINT AS other, CASE WHEN coalesce(own + other, 0) = 0 THEN 'none' WHEN 20 * other < own + other THEN 'own' WHEN 20 * own < own + other THEN 'other' ELSE 'mixed' END AS origin FROM nation LEFT JOIN h ON region = n_name""")
def coverage_by_region(spark, d):
    a = located(read(spark, d, "customer"), "c_custkey").select(F.lit("c").alias("src"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), "lon", "lat")
    b = located(read(spark, d, "supplier").withColumn("k", F.col("s_suppkey") * 3), "k").select(F.lit("s").alias("src"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), "lon", "lat")
    shapes = boxes(read(spark, d, "nation"), 9.0, 4.0)
    hit = spatial.points_in_polygons(a.unionByName(b), shapes, "id", "region")
    counts = hit.groupBy("region").agg(F.count_if(F.col("id").startswith("c")).alias("own"), F.count_if(F.col("id").startswith("s")).alias("other"))
    every = read(spark, d, "nation").select(F.col("n_name").alias("region")).join(counts, "region", "left").fillna(0, ["own", "other"])
    return every.withColumn("origin", C.single_origin(F.col("own"), F.col("other")))


RANKED = """k AS (SELECT o_orderkey, o_custkey, date_trunc('month', o_orderdate) AS month, o_orderpriority AS pri, o_totalprice, 30 + (o_orderkey * 7 % 40) / 10000.0::DOUBLE AS lat, -90 + (o_orderkey * 11 % 40) / 10000.0::DOUBLE AS lon FROM orders),
r AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, month) AS copies, row_number() OVER w AS place, first_value(lat) OVER w AS blat, first_value(lon) OVER w AS blon FROM k WINDOW w AS (PARTITION BY o_custkey, month ORDER BY pri, o_totalprice DESC, o_orderkey)),
m AS (SELECT *, 111320.0::DOUBLE * sqrt((lat - blat) * (lat - blat) + ((lon - blon) * cos(radians(blat))) * ((lon - blon) * cos(radians(blat)))) AS metres_off FROM r),
f AS (SELECT *, place > 1 AND metres_off <= 100 AS dup, bool_or(metres_off > 100) OVER (PARTITION BY o_custkey, month) AS far FROM m)"""


def _orders(spark, d):
    k = F.col("o_orderkey")
    return read(spark, d, "orders").select("o_orderkey", "o_custkey", F.date_trunc("month", "o_orderdate").alias("month"), F.col("o_orderpriority").alias("pri"), "o_totalprice", "o_orderstatus", (30 + (k * 7 % 40) / F.lit(10000.0)).alias("lat"), (-90 + (k * 11 % 40) / F.lit(10000.0)).alias("lon"))


def _order():
    return [F.asc("pri"), F.desc_nulls_last("o_totalprice"), F.asc_nulls_last("o_orderkey")]


@query(f"WITH {RANKED} SELECT o_orderkey::BIGINT AS o_orderkey, copies::BIGINT AS copies, place::BIGINT AS place, round(metres_off, 4) AS metres_off FROM f")
def dedup_rank(spark, d):
    return duplicates.ranked(_orders(spark, d), ["o_custkey", "month"], _order()).select("o_orderkey", "copies", "place", F.round("metres_off", 4).alias("metres_off"))


@query(f"WITH {RANKED} SELECT o_orderkey::BIGINT AS o_orderkey, dup AS is_duplicate, far AS elsewhere FROM f")
def dedup_pass1(spark, d):
    return duplicates.ranked(_orders(spark, d), ["o_custkey", "month"], _order()).select("o_orderkey", "is_duplicate", "elsewhere")


@query(f"""WITH {RANKED}, s AS (SELECT o_orderkey, k.* EXCLUDE (o_orderkey), o.o_orderstatus AS st, year(o.o_orderdate) AS y FROM f JOIN k USING (o_orderkey) JOIN orders o USING (o_orderkey) WHERE NOT dup),
s2 AS (SELECT *, row_number() OVER w AS place, first_value(lat) OVER w AS blat, first_value(lon) OVER w AS blon FROM s WINDOW w AS (PARTITION BY o_custkey, month, st ORDER BY pri, o_totalprice DESC, o_orderkey)),
d2 AS (SELECT o_orderkey FROM s2 WHERE place > 1 AND 111320.0::DOUBLE * sqrt((lat - blat) * (lat - blat) + ((lon - blon) * cos(radians(blat))) * ((lon - blon) * cos(radians(blat)))) <= 100)
SELECT f.o_orderkey::BIGINT AS o_orderkey, dup OR d2.o_orderkey IS NOT NULL AS is_duplicate, far AND NOT (dup OR d2.o_orderkey IS NOT NULL) AS elsewhere FROM f LEFT JOIN d2 USING (o_orderkey)""".replace("SELECT o_orderkey, k.* EXCLUDE (o_orderkey), o.o_orderstatus AS st, year(o.o_orderdate) AS y FROM", "SELECT f.o_orderkey, f.o_custkey, f.month, f.pri, f.o_totalprice, f.lat, f.lon, o.o_orderstatus AS st FROM").replace("FROM f JOIN k USING (o_orderkey) JOIN orders o USING (o_orderkey)", "FROM f JOIN orders o ON o.o_orderkey = f.o_orderkey"))
def dedup_verdict(spark, d):
    return duplicates.verdicts(_orders(spark, d), ["o_custkey", "month"], ["o_custkey", "month", "o_orderstatus"], _order()).select("o_orderkey", "is_duplicate", "elsewhere")


@query("""WITH t AS (SELECT doc_id, md5(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')) AS h FROM documents) SELECT doc_id::BIGINT AS doc_id, row_number() OVER (PARTITION BY h ORDER BY doc_id) > 1 AS is_duplicate FROM t""")
def normalised_text_copies(spark, d):
    """Texts are hashed where they are read, once; only hashes and ids are moved."""
    key = F.unhex(F.md5(F.regexp_replace(F.lower("text"), "[^a-z]+", " ")))
    rows = read(spark, d, "documents").select("doc_id", key.alias("h"))
    return duplicates.after_first(rows, "h", "doc_id")


@query("""SELECT n_name, count(c_custkey)::BIGINT AS n FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9000) ON c_nationkey = n_nationkey GROUP BY n_name""")
def zero_filled_counts(spark, d):
    hits = read(spark, d, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return read(spark, d, "nation").join(hits, "n_nationkey", "left").select("n_name", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("""WITH w AS (SELECT event_type, date_trunc('week', ts)::DATE::VARCHAR AS week, count(*)::BIGINT AS n FROM events GROUP BY ALL) SELECT event_type, week, n, sum(n) OVER (PARTITION BY event_type ORDER BY week)::BIGINT AS total FROM w""")
def series_rollup(spark, d):
    weekly = read(spark, d, "events").groupBy("event_type", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return weekly.withColumn("total", F.sum("n").over(Window.partitionBy("event_type").orderBy("week")))


@query("""WITH r AS (SELECT n_name, count(c_custkey)::BIGINT AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name), s AS (SELECT n_name, count(s_suppkey)::BIGINT AS m FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name)
SELECT n_name, CASE WHEN n = 0 THEN 'none' WHEN 100.0::DOUBLE * m / n < 1 THEN 'under 1' WHEN 100.0::DOUBLE * m / n < 5 THEN '1 to 5' WHEN 100.0::DOUBLE * m / n < 25 THEN '5 to 25' WHEN 100.0::DOUBLE * m / n < 75 THEN '25 to 75' ELSE '75 and more' END AS class FROM r JOIN s USING (n_name)""")
def ratio_classes(spark, d):
    count = lambda t, k, n: read(spark, d, t).groupBy(F.col(k).alias("n_nationkey")).agg(F.count(F.lit(1)).alias(n))
    rows = read(spark, d, "nation").join(count("customer", "c_nationkey", "n"), "n_nationkey", "left").join(count("supplier", "s_nationkey", "m"), "n_nationkey", "left").fillna(0, ["n", "m"])
    per = F.lit(100.0) * F.col("m") / F.when(F.col("n") > 0, F.col("n"))
    return rows.select("n_name", F.when(F.col("n") == 0, "none").when(per < 1, "under 1").when(per < 5, "1 to 5").when(per < 25, "5 to 25").when(per < 75, "25 to 75").otherwise("75 and more").alias("class"))


@query("SELECT c_custkey::BIGINT AS c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def semi_membership(spark, d):
    return read(spark, d, "customer").join(read(spark, d, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey")


@query("SELECT c_custkey::BIGINT AS c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def anti_membership(spark, d):
    return read(spark, d, "customer").join(read(spark, d, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("""WITH c AS (SELECT o_orderpriority AS street, nullif(o_custkey % 5, 0) AS county, o_orderstatus AS city, count(*)::BIGINT AS n FROM orders GROUP BY ALL)
SELECT street, county::BIGINT AS county, city, n FROM c QUALIFY row_number() OVER (PARTITION BY street, county ORDER BY n DESC, city) <= 6""")
def same_group_neighbours(spark, d):
    counted = read(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("street"), F.nullif(F.col("o_custkey") % 5, F.lit(0)).alias("county"), F.col("o_orderstatus").alias("city")).agg(F.count(F.lit(1)).alias("n"))
    place_in = F.row_number().over(Window.partitionBy("street", "county").orderBy(F.desc("n"), "city"))
    return counted.withColumn("k", place_in).where("k <= 6").drop("k")


@query("""WITH g AS (SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS c FROM lineitem GROUP BY ALL), m AS (SELECT l_returnflag, l_linestatus, l_quantity AS q FROM g QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY c DESC, l_quantity) = 1)
SELECT l_returnflag, l_linestatus, q AS usual, bool_and(l_discount <= 0.1) AS all_low, max(l_orderkey)::BIGINT AS sample FROM lineitem JOIN m USING (l_returnflag, l_linestatus) GROUP BY ALL""")
def top1_with_sample(spark, d):
    return read(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.mode("l_quantity", True).alias("usual"), F.bool_and(F.col("l_discount") <= 0.1).alias("all_low"), F.max("l_orderkey").alias("sample"))


@query("""WITH a AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) WHEN p_partkey % 3 = 1 THEN p_name ELSE replace(p_name, ' ', '-') END AS name FROM part), b AS (SELECT DISTINCT p_name FROM part)
SELECT p_partkey::BIGINT AS p_partkey, CASE WHEN e.p_name IS NOT NULL THEN 'exact' WHEN l.k IS NOT NULL THEN 'case' WHEN p.k IS NOT NULL THEN 'punctuation' ELSE 'none' END AS how FROM a LEFT JOIN b e ON e.p_name = name LEFT JOIN (SELECT DISTINCT lower(p_name) AS k FROM b) l ON l.k = lower(name) LEFT JOIN (SELECT DISTINCT regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS k FROM b) p ON p.k = regexp_replace(lower(name), '[^a-z0-9]', '', 'g')""")
def name_match_cascade(spark, d):
    part = read(spark, d, "part")
    k = F.col("p_partkey") % 3
    rows = part.select("p_partkey", F.when(k == 0, F.upper("p_name")).when(k == 1, F.col("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("name"))
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    known = part.select("p_name").distinct()
    keys = [("exact", lambda c: F.col(c)), ("case", F.lower), ("punctuation", bare)]
    for how, of in keys:
        side = known.select(of("p_name").alias(f"{how}_key")).distinct().withColumn(how, F.lit(True))
        rows = rows.join(side, of("name") == F.col(f"{how}_key"), "left").drop(f"{how}_key")
    return rows.select("p_partkey", F.coalesce(*(F.when(F.col(how), how) for how, _ in keys), F.lit("none")).alias("how"))


@query(f"""WITH c AS (SELECT c_custkey, {place('c_custkey')} FROM customer) SELECT c_custkey::BIGINT AS c_custkey FROM c WHERE (lon BETWEEN -120 AND -110 AND lat BETWEEN 30 AND 35) OR (lon BETWEEN -90 AND -85 AND lat BETWEEN 40 AND 49)""")
def bbox_scan(spark, d):
    rows = located(read(spark, d, "customer"), "c_custkey")
    within = lambda x1, y1, x2, y2: F.col("lon").between(x1, x2) & F.col("lat").between(y1, y2)
    return rows.where(within(-120, 30, -110, 35) | within(-90, 40, -85, 49)).select("c_custkey")


@query("""SELECT c_custkey::BIGINT AS c_custkey, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (c_custkey * 7919 % 5000)::VARCHAR || ',' || (c_custkey * 104729 % 2400)::VARCHAR || ']},"properties":{"addr:city":"' || c_mktsegment || '","addr:unit":"' || c_nationkey::VARCHAR || '"}}' AS feature FROM customer""")
def geojson_rows(spark, d):
    k = F.col("c_custkey")
    geometry = F.struct(F.lit("Point").alias("type"), F.array(k * 7919 % 5000, k * 104729 % 2400).alias("coordinates"))
    properties = F.struct(F.col("c_mktsegment").alias("addr:city"), F.col("c_nationkey").cast("string").alias("addr:unit"))
    return read(spark, d, "customer").select("c_custkey", F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))).alias("feature"))
