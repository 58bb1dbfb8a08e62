"""Driver-facing queries of the address rules and of smaller operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions.columns import blank_to_null, clean
from waymark.functions.places import read_decisions
from waymark.operators import place_names, python_rules, saints
from waymark.operators.memo import apply_rule
from waymark.plans import golden
from waymark.plans.address_queries import query, read
from waymark.schema import RAW_COLUMNS
from waymark.sources import registry
from waymark.stages import tagging
from waymark.stages.deduplication import county_name

_STREET_FIELDS = tagging.STREET_INPUTS
_rows = lambda streets: [(*(fields.get(c) for c in _STREET_FIELDS), k) for k, (fields, _, _) in enumerate(streets)]
_STREET_ROWS, _RELEASE_ROWS = _rows(golden.STREETS), _rows(golden.RELEASE_STREETS)
_SORTED = lambda flags: ",".join(sorted(filter(None, flags.split(","))))
_STREET_SQL = golden.sql_values([(street, flags) for _, street, flags in golden.STREETS], "street", "flags")
_CITY_SQL = golden.sql_values([(city, _SORTED(flags)) for *_, city, flags in golden.CITIES], "city", "flags")


def examples(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names) + ", k int")


def known_places(spark: SparkSession):
    return place_names.load_places(spark.createDataFrame(golden.PLACE_ROWS, "state string, name string, source string"), read_decisions(golden.DECISIONS))


@query(f"SELECT o_orderkey::BIGINT AS o_orderkey, street, flags FROM orders JOIN {_STREET_SQL} ON k = o_orderkey % {len(golden.STREETS)}")
def street_rule(spark, d):
    cleaned = [f"{c}__c" for c in _STREET_FIELDS]
    given = examples(spark, _STREET_ROWS, _STREET_FIELDS).withColumns({f"{c}__c": clean(F.col(c)) for c in _STREET_FIELDS})
    rows = read(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % len(golden.STREETS)).alias("k")).join(given, "k")
    ruled = rows.withColumn("r", python_rules.street_rule()(*map(F.col, cleaned)))
    return ruled.select("o_orderkey", F.col("r.value").alias("street"), F.array_join("r.flags", ",").alias("flags"))


@query(f"SELECT c_custkey::BIGINT AS c_custkey, value, flags FROM customer JOIN {golden.sql_values([(v, f) for _, _, v, f in golden.UNITS], 'value', 'flags')} ON k = c_custkey % {len(golden.UNITS)}")
def unit_rule(spark, d):
    given = examples(spark, [(u, b, k) for k, (u, b, _, _) in enumerate(golden.UNITS)], ["unit", "building"])
    rows = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % len(golden.UNITS)).alias("k")).join(given, "k").withColumns({"u": clean(F.col("unit")), "b": clean(F.col("building"))})
    return rows.withColumn("r", python_rules.unit_rule()(F.col("u"), F.col("b"))).select("c_custkey", "r.value", F.array_join("r.flags", ",").alias("flags"))


@query(f"SELECT c_custkey::BIGINT AS c_custkey, city, flags FROM customer JOIN {_CITY_SQL} ON k = c_custkey % {len(golden.CITIES)}")
def city_rule(spark, d):
    names = ["post", "muni", "comm", "state", "county"]
    given = examples(spark, [(*row[:5], k) for k, row in enumerate(golden.CITIES)], names).withColumns({f"{c}__c": clean(F.col(c)) for c in names})
    rows = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % len(golden.CITIES)).alias("k")).join(given, "k")
    ruled = rows.withColumn("r", python_rules.city_rule(known_places(spark))(*(F.col(f"{c}__c") for c in names)))
    return ruled.select("c_custkey", F.col("r.value").alias("city"), F.array_join(F.array_sort("r.flags"), ",").alias("flags"))


def generated_release(spark: SparkSession, d: str) -> DataFrame:
    """A raw table over all orders: street examples with their state and county, house numbers, ZIP codes and life cycles by order key."""
    k = F.col("o_orderkey")
    given = examples(spark, _RELEASE_ROWS, _STREET_FIELDS)
    rows = read(spark, d, "orders").withColumn("k", k % len(golden.RELEASE_STREETS)).join(given, "k")
    made = {
        "OID_": k.cast("string"), "UUID": k.cast("string"), "Add_Number": F.when(k % 17 == 0, None).otherwise(F.concat(F.lit("00"), (k % 900).cast("string"))), "AddNum_Suf": F.when(k % 19 == 0, "a"),
        "Unit": F.when(k % 5 == 0, "apt 1"), "Post_City": F.when(k % 3 == 0, "MC PHERSON").when(k % 3 == 1, "Zone 4"), "State": F.coalesce("State", F.lit("KS")), "Zip_Code": F.when(k % 2 == 0, "67460").otherwise("674"),
        "Longitude": F.lit("-97.5"), "Latitude": F.when(k % 7 == 0, "n/a").otherwise("38.25"), "Lifecycle": F.when(k % 23 == 0, " Not  Active "), "NAD_Source": F.concat(F.lit("s"), (k % 4).cast("string")),
    }
    return rows.select(*(made.get(c, F.col(c) if c in given.columns else F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS))


@query(f"""WITH g AS (SELECT * FROM {golden.sql_values([(s, f, fields.get('State', 'KS')) for fields, s, f in golden.RELEASE_STREETS], 'street', 'sflags', 'state')}),
t AS (SELECT o_orderkey AS o, street, sflags, CASE WHEN o_orderkey % 17 = 0 THEN 'no_housenumber' WHEN o_orderkey % 900 = 0 THEN 'zero_housenumber' WHEN street IS NULL THEN sflags WHEN o_orderkey % 23 = 0 THEN 'inactive_lifecycle' END AS drop_reason,
list_filter([CASE WHEN o_orderkey % 3 <> 0 THEN 'no_city' WHEN state <> 'KS' THEN 'city_not_in_reference' END, CASE WHEN o_orderkey % 2 = 1 THEN 'bad_postcode' END], lambda x: x IS NOT NULL) AS others FROM orders JOIN g ON k = o_orderkey % {len(golden.RELEASE_STREETS)})
SELECT o::VARCHAR AS nad_oid, street AS addr_street, CASE WHEN o % 17 <> 0 AND o % 900 <> 0 THEN (o % 900)::VARCHAR || CASE WHEN o % 19 = 0 THEN ' A' ELSE '' END END AS addr_housenumber,
CASE WHEN o % 5 = 0 THEN 'Apt 1' END AS addr_unit, CASE WHEN o % 3 = 0 THEN 'McPherson' END AS addr_city, CASE WHEN o % 2 = 0 THEN '67460' END AS addr_postcode, CASE WHEN o % 7 <> 0 THEN 38.25 END AS lat, drop_reason,
array_to_string(list_sort(list_distinct(list_concat(list_filter(string_split(sflags, ','), lambda x: x <> ''), others))), ',') AS flags FROM t""")
def tagged_release(spark, d):
    points = tagging.tagged_points(generated_release(spark, d), known_places(spark))
    return points.select("nad_oid", "addr_street", "addr_housenumber", "addr_unit", "addr_city", "addr_postcode", "lat", "drop_reason", F.array_join("flags", ",").alias("flags"))


@query(f"""WITH n AS (SELECT p_partkey AS k, p_type AS state, string_split(p_name, ' ') AS t FROM part),
s AS (SELECT DISTINCT state, CASE k % 6 WHEN 0 THEN 'ST ' || upper(t[1]) || ' ' || upper(t[-1]) WHEN 1 THEN 'St. ' || t[-1] || CASE WHEN k % 4 = 1 THEN chr(39) ELSE '' END || 's' WHEN 2 THEN 'Old  Saint ' || t[1] WHEN 3 THEN 'ST RD ' || k::VARCHAR WHEN 4 THEN 'ST ' || k::VARCHAR ELSE upper(t[-1]) || ' ST ' || upper(t[1]) END AS name FROM n), p AS (SELECT DISTINCT 'Sainte ' || t[-1] AS name FROM n WHERE k % 5 = 0),
w AS (SELECT state, string_split(upper(regexp_replace(replace(replace(name, '.', ''), chr(39), ''), ' +', ' ', 'g')), ' ') AS w FROM s UNION ALL SELECT NULL, string_split(upper(name), ' ') FROM p), d AS (SELECT DISTINCT state, w FROM w),
h AS (SELECT lower(w[i + 1]) AS word, 1 AS spelled, 0 AS short FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE w[i] IN ('SAINT', 'SAINTE') UNION ALL SELECT lower(w[2]), 0, 1 FROM d WHERE w[1] = 'ST')
SELECT word, sum(spelled)::BIGINT AS n_spelled, sum(short)::BIGINT AS n_short FROM h WHERE regexp_full_match(word, '[a-z]{{2,}}') AND upper(word) NOT IN ({', '.join(repr(x) for x in saints.NO_SAINTS)}) GROUP BY word HAVING sum(spelled) > 0 OR sum(short) >= 2""")
def saint_words(spark, d):
    """Names of parts as streets: behind ST, St., Saint and inside, numbers and routes behind ST; some as places behind Sainte."""
    k, t = F.col("p_partkey"), F.split("p_name", " ")
    first, last = F.element_at(t, 1), F.element_at(t, -1)
    name = F.when(k % 6 == 0, F.concat(F.lit("ST "), F.upper(first), F.lit(" "), F.upper(last))).when(k % 6 == 1, F.concat(F.lit("St. "), last, F.when(k % 4 == 1, "'").otherwise(""), F.lit("s"))).when(k % 6 == 2, F.concat(F.lit("Old  Saint "), first))
    name = name.when(k % 6 == 3, F.concat(F.lit("ST RD "), k.cast("string"))).when(k % 6 == 4, F.concat(F.lit("ST "), k.cast("string"))).otherwise(F.concat(F.upper(last), F.lit(" ST "), F.upper(first)))
    part = read(spark, d, "part")
    return saints.saint_words(part.select(F.col("p_type").alias("state"), name.alias("name")), part.where(k % 5 == 0).select(F.concat(F.lit("Sainte "), last).alias("name")))


@query("""WITH s AS (SELECT DISTINCT p_type AS state, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name ELSE replace(p_name, ' ', '-') END AS name, CASE p_partkey % 4 WHEN 0 THEN 'census_place' WHEN 1 THEN 'gnis' WHEN 2 THEN 'census_cousub' ELSE 'wikidata' END AS source FROM part),
v AS (SELECT state, regexp_replace(lower(name), '[ -]', '', 'g') AS key, name, count(*) AS n, list_position(['census_place', 'gnis', 'census_cousub', 'wikidata'], min(source)) AS rank, bool_and(source = 'gnis') AS hamlet FROM s GROUP BY ALL)
SELECT state, key, name, n::BIGINT AS n, bool_and(hamlet) OVER w AS hamlet, (count(*) OVER w)::BIGINT AS n_spellings FROM v WINDOW w AS (PARTITION BY state, key) QUALIFY row_number() OVER (PARTITION BY state, key ORDER BY n DESC, rank, name) = 1""")
def spelling_votes(spark, d):
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.upper("p_name")).when(k % 3 == 1, F.col("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    source = F.when(k % 4 == 0, "census_place").when(k % 4 == 1, "gnis").when(k % 4 == 2, "census_cousub").otherwise("wikidata")
    return place_names.spellings(read(spark, d, "part").select(F.col("p_type").alias("state"), name.alias("name"), source.alias("source")))


@query("""WITH n AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS head, string_split(p_name, ' ')[-1] AS tail FROM part)
SELECT a.head, a.tail AS a, b.tail AS b, levenshtein(a.tail, b.tail)::BIGINT AS edits FROM n a JOIN n b ON a.head = b.head AND a.tail < b.tail
UNION ALL SELECT head, tail, tail[2] || tail[1] || tail[3:], CASE WHEN tail[1] = tail[2] THEN 0 ELSE 1 END FROM n""")
def edit_distance_pairs(spark, d):
    """Words of the table have no letters to swap, so plain edits count the same; words with their first letters swapped are one edit away."""
    words = F.split("p_name", " ")
    names = read(spark, d, "part").select(F.element_at(words, 1).alias("head"), F.element_at(words, -1).alias("tail")).distinct()
    pairs = names.withColumnRenamed("tail", "a").join(names.withColumnRenamed("tail", "b"), "head").where("a < b")
    swapped = names.select("head", F.col("tail").alias("a"), F.concat(F.substring("tail", 2, 1), F.substring("tail", 1, 1), F.substring("tail", 3, 99)).alias("b"))
    return apply_rule(pairs.unionByName(swapped), ["a", "b"], python_rules.edit_distance, "edits")


@query("""WITH f AS (SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'A' ELSE 'B' END AS state, n_nationkey::VARCHAR AS zip, n_name AS city FROM nation), c AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS state, c_nationkey::VARCHAR AS zip, CASE WHEN c_custkey % 4 < 2 THEN c_mktsegment END AS city FROM customer)
SELECT c_custkey::BIGINT AS c_custkey, coalesce(c.city, f.city) AS city, c.city IS NULL AND f.city IS NOT NULL AS filled FROM c LEFT JOIN f ON f.state = c.state AND f.zip = c.zip""")
def zip_fact_fill(spark, d):
    side = lambda c: F.when(F.col(c) % 2 == 0, "A").otherwise("B")
    facts = read(spark, d, "nation").select(side("n_regionkey").alias("state"), F.col("n_nationkey").cast("string").alias("zip"), F.col("n_name").alias("fact"))
    rows = read(spark, d, "customer").select("c_custkey", side("c_custkey").alias("state"), F.col("c_nationkey").cast("string").alias("zip"), F.when(F.col("c_custkey") % 4 < 2, F.col("c_mktsegment")).alias("city"))
    return rows.join(facts, ["state", "zip"], "left").select("c_custkey", F.coalesce("city", "fact").alias("city"), (F.col("city").isNull() & F.col("fact").isNotNull()).alias("filled"))


@query("""SELECT event_id::BIGINT AS event_id, TRY_CAST(CASE WHEN event_id % 9 = 0 THEN 'x' ELSE value::VARCHAR END AS DOUBLE) AS value, '0' || user_id::VARCHAR AS user_text, event_type || ', "' || user_id::VARCHAR || '"' AS label FROM events""")
def typed_scan(spark, d):
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    value = F.when(F.col("event_id") % 9 == 0, "x").otherwise(F.col("value").cast("string"))
    label = F.concat("event_type", F.lit(', "'), F.col("user_id").cast("string"), F.lit('"'))
    line = F.concat_ws(",", F.col("event_id").cast("string"), value, F.concat(F.lit("0"), F.col("user_id").cast("string")), quoted(label))
    text = read(spark, d, "events").select(F.from_csv(line, "event_id string, value string, user_text string, label string", {"quote": '"', "escape": '"'}).alias("r"))
    return text.select(F.expr("try_cast(r.event_id as bigint)").alias("event_id"), tagging.degrees(F.col("r.value")).alias("value"), "r.user_text", "r.label")


_NOT_IN = """SELECT 'with nulls' AS listed, c_custkey FROM {c} WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END FROM {o})
UNION ALL SELECT 'without nulls', c_custkey FROM {c} WHERE c_custkey NOT IN (SELECT o_custkey FROM {o} WHERE o_orderkey % 2 = 0 AND o_custkey IS NOT NULL)
UNION ALL SELECT 'null asked', c_custkey FROM {c} WHERE nullif(c_mktsegment, 'BUILDING') NOT IN (SELECT p_type FROM {p} WHERE p_type IS NOT NULL)"""


@query(f"SELECT listed, c_custkey::BIGINT AS c_custkey FROM ({_NOT_IN.format(c='customer', o='orders', p='part')})")
def not_in_with_nulls(spark, d):
    """A null in the list leaves nothing; without one the rest stays, but rows whose own value is null."""
    return spark.sql(_NOT_IN, c=read(spark, d, "customer"), o=read(spark, d, "orders"), p=read(spark, d, "part"))


@query("""SELECT o_orderstatus, count(*) FILTER (WHERE list_contains(f, 'large'))::BIGINT AS n_large, count(*) FILTER (WHERE list_contains(f, 'third'))::BIGINT AS n_third FROM (SELECT o_orderstatus, list_filter([CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_custkey % 3 = 0 THEN 'third' END], lambda x: x IS NOT NULL) AS f FROM orders) GROUP BY o_orderstatus""")
def array_membership(spark, d):
    made = F.array_compact(F.array(F.when(F.col("o_totalprice") > 200000, "large"), F.when(F.col("o_custkey") % 3 == 0, "third")))
    rows = read(spark, d, "orders").select("o_orderstatus", made.alias("f"))
    return rows.groupBy("o_orderstatus").agg(F.count_if(F.array_contains("f", "large")).alias("n_large"), F.count_if(F.array_contains("f", "third")).alias("n_third"))


@query("""SELECT n_name, row_number() OVER (ORDER BY n_regionkey DESC, n_name)::BIGINT AS ordinal FROM nation""")
def ordinal_ids(spark, d):
    """Numbers some thousands of shapes: the order is total and the table small, so one task holds it."""
    return read(spark, d, "nation").select("n_name", F.row_number().over(Window.orderBy(F.desc("n_regionkey"), "n_name")).cast("long").alias("ordinal"))


@query("""WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 0), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000) SELECT k::BIGINT AS nation FROM a EXCEPT SELECT k::BIGINT FROM b""")
def set_difference(spark, d):
    a = read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_nationkey").cast("long").alias("nation"))
    b = read(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").cast("long").alias("nation"))
    return a.subtract(b)


@query("""SELECT o_orderstatus, array_to_string(list_sort(list(DISTINCT coalesce(nullif(o_custkey % 5, 0)::VARCHAR, '-'))), ',') AS counties FROM orders GROUP BY o_orderstatus""")
def distinct_lists(spark, d):
    county = F.coalesce(F.nullif(F.col("o_custkey") % 5, F.lit(0)).cast("string"), F.lit("-"))
    return read(spark, d, "orders").groupBy("o_orderstatus").agg(F.array_join(F.array_sort(F.collect_set(county)), ",").alias("counties"))


@query("""WITH e AS (SELECT l_orderkey, l_partkey, min(l_suppkey % 25) AS area FROM lineitem GROUP BY ALL) SELECT n_name, count(area)::BIGINT AS n FROM nation LEFT JOIN e ON area = n_nationkey GROUP BY n_name""")
def element_counts(spark, d):
    elements = read(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min(F.col("l_suppkey") % 25).alias("area"))
    counts = elements.groupBy("area").agg(F.count(F.lit(1)).alias("n"))
    nation = read(spark, d, "nation")
    return nation.join(counts, nation.n_nationkey == counts.area, "left").select("n_name", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("""SELECT c_custkey::BIGINT AS c_custkey, CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE (c_custkey % 180)::VARCHAR || '.5' END AS lon, CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE '-' || (c_custkey % 90)::VARCHAR || '.25' END AS lat FROM customer""")
def wkt_points(spark, d):
    k = F.col("c_custkey")
    whole = F.concat((k % 180).cast("string"), F.lit(".5 -"), (k % 90).cast("string"), F.lit(".25"))
    text = F.when(k % 6 == 5, "POLYGON EMPTY").when(k % 2 == 0, F.concat(F.lit("POINT ("), whole, F.lit(")"))).otherwise(F.concat(F.lit("point( "), whole, F.lit(" )")))
    lon, lat = registry.wkt_point(F.col("wkt"))
    return read(spark, d, "customer").select("c_custkey", text.alias("wkt")).select("c_custkey", lon.alias("lon"), lat.alias("lat"))


MARKETS = """
state = "KS"
name = "Markets"
publisher = "A city"
[access]
protocol = "socrata"
url = "https://example.org/rows.csv"
[licence]
class = "cc0"
name = "CC0"
source = "https://example.org/terms"
quote = "no rights reserved"
verified = "2024-01-01"
[fields]
id = "rid"
Add_Number = "number"
St_Name = ["kind", "street name"]
Point_WKT = "place"
"""


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey::VARCHAR END AS rid, c_custkey::VARCHAR AS num, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ' ' ELSE '' END || c_name AS st FROM customer),
k AS (SELECT *, coalesce(rid, md5(concat_ws('|', num, st, '-97.5', '38.25'))) AS key FROM r), c AS (SELECT *, 'markets:' || key || CASE row_number() OVER (PARTITION BY key ORDER BY num, st) WHEN 1 THEN '' ELSE '#' || row_number() OVER (PARTITION BY key ORDER BY num, st)::VARCHAR END AS oid FROM k)
SELECT oid AS OID_, num AS Add_Number, st AS St_Name, '-97.5' AS Longitude, 'KS' AS State, '{' || upper(substr(md5(oid), 1, 8) || '-' || substr(md5(oid), 9, 4) || '-' || substr(md5(oid), 13, 4) || '-' || substr(md5(oid), 17, 4) || '-' || substr(md5(oid), 21, 12)) || '}' AS UUID FROM c""")
def mapped_source_rows(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(F.when(k % 3 != 0, F.col("c_nationkey").cast("string")).alias("rid"), k.cast("string").alias("number"), F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("  ").alias("kind"), F.col("c_name").alias("street name"), F.lit("POINT (-97.5 38.25)").alias("place"))
    return registry.raw_rows(rows, registry.read_source("markets", MARKETS)).select("OID_", "Add_Number", "St_Name", "Longitude", "State", "UUID")


@query("""SELECT n_nationkey::BIGINT AS n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'East Oak' WHEN 1 THEN 'Fair Haven' WHEN 2 THEN NULL WHEN 3 THEN 'Little Ford' ELSE NULL END AS name, CASE n_nationkey % 5 WHEN 0 THEN 'orleans' WHEN 1 THEN 'sitka' WHEN 2 THEN 'st. mary' WHEN 3 THEN 'carson' ELSE '' END AS county FROM nation""")
def descriptor_keys(spark, d):
    k = F.col("n_nationkey") % 5
    name = F.when(k == 0, "East Oak city (balance)").when(k == 1, "Fair Haven CDP").when(k == 2, "Turner CCD").when(k == 3, "Little Ford charter township").otherwise("District 7")
    county = F.when(k == 0, "Orleans Parish").when(k == 1, "Sitka City and Borough").when(k == 2, "St. Mary County").when(k == 3, "Carson City")
    return read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), place_names.without_descriptor(name).alias("name"), county_name(county).alias("county"))


@query("""WITH t AS (SELECT DISTINCT o_orderpriority AS street, o_orderstatus AS city, (o_custkey % 40)::VARCHAR AS unit FROM orders)
SELECT street, city, unit, row_number() OVER (PARTITION BY street, city ORDER BY unit::BIGINT, unit)::BIGINT AS place, count(*) OVER (PARTITION BY street, city)::BIGINT - 12 AS more FROM t QUALIFY place <= 12""")
def display_top(spark, d):
    tags = read(spark, d, "orders").select(F.col("o_orderpriority").alias("street"), F.col("o_orderstatus").alias("city"), (F.col("o_custkey") % 40).cast("string").alias("unit")).distinct()
    group = Window.partitionBy("street", "city")
    ranked = tags.withColumns({"place": F.row_number().over(group.orderBy(F.col("unit").cast("bigint"), "unit")).cast("long"), "more": F.count(F.lit(1)).over(group) - 12})
    return ranked.where("place <= 12")


@query("""WITH w AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT event_type, max(n) AS top FROM w GROUP BY ALL)
SELECT event_type, (SELECT x.day::VARCHAR FROM w x WHERE x.event_type = m.event_type ORDER BY abs(date_diff('day', x.day, DATE '2024-01-15')), x.day LIMIT 1) AS nearest, CASE WHEN top <= pow(10, floor(log10(top))) THEN pow(10, floor(log10(top))) WHEN top <= 2 * pow(10, floor(log10(top))) THEN 2 * pow(10, floor(log10(top))) WHEN top <= 5 * pow(10, floor(log10(top))) THEN 5 * pow(10, floor(log10(top))) ELSE 10 * pow(10, floor(log10(top))) END AS axis FROM m""")
def nearest_date_and_axis(spark, d):
    daily = read(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    near = F.min(F.struct(F.abs(F.datediff("day", F.lit("2024-01-15").cast("date"))).alias("off"), "day"))
    own = daily.groupBy("event_type").agg(near.alias("near"), F.max("n").alias("top"))
    unit = F.pow(F.lit(10.0), F.floor(F.log10("top")))
    axis = F.when(F.col("top") <= unit, unit).when(F.col("top") <= 2 * unit, 2 * unit).when(F.col("top") <= 5 * unit, 5 * unit).otherwise(10 * unit)
    return own.select("event_type", F.col("near.day").cast("string").alias("nearest"), axis.alias("axis"))


@query("""WITH r AS (SELECT p_type, coalesce(nullif(trim(p_brand), ''), 'none') AS brand, p_size % 2 = 0 AS even, p_name FROM part) SELECT p_type, max(p_name) FILTER (WHERE even) AS best FROM r GROUP BY p_type""")
def sample_by_flag(spark, d):
    """arg_max of a text by a condition, ties by the text."""
    rows = read(spark, d, "part").select("p_type", blank_to_null(F.col("p_brand")).alias("brand"), (F.col("p_size") % 2 == 0).alias("even"), "p_name")
    best = rows.groupBy("p_type").agg(F.max(F.struct(F.col("even").cast("int").alias("even"), "p_name")).alias("b"))
    return best.select("p_type", F.when(F.col("b.even") == 1, F.col("b.p_name")).alias("best"))
