"""Driver-facing queries that run the street, unit and city rules on names made of the tables' own words, with SQL that states the rules anew."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions.columns import clean
from waymark.operators import place_names, python_rules
from waymark.plans.address_queries import query, read
from waymark.stages.tagging import STREET_INPUTS

_TITLE = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2 :]), ' ')"


@query(f"""WITH n AS (SELECT p_partkey AS k, {_TITLE} AS name, ['Street', 'Avenue', 'Lane', 'Court', 'Parkway', 'Circle'][p_size % 6 + 1] AS kind, p_partkey % 90 + 1 AS n, p_partkey % 8 AS v FROM part),
o AS (SELECT *, n::VARCHAR || CASE WHEN n % 100 BETWEEN 11 AND 13 THEN 'th' WHEN n % 10 = 1 THEN 'st' WHEN n % 10 = 2 THEN 'nd' WHEN n % 10 = 3 THEN 'rd' ELSE 'th' END AS nth FROM n)
SELECT k::BIGINT AS p_partkey, CASE v WHEN 0 THEN name || ' ' || kind WHEN 1 THEN 'North ' || name || ' ' || kind WHEN 2 THEN name || ' Road' WHEN 3 THEN name || ' ' || kind || ' Southwest' WHEN 4 THEN nth || ' Street' WHEN 5 THEN 'Mount ' || name || ' ' || kind WHEN 6 THEN 'West ' || name || ' ' || kind || ' West' END AS street,
CASE v WHEN 1 THEN 'name_had_directional' WHEN 2 THEN 'name_had_type' WHEN 3 THEN 'name_had_directional' WHEN 4 THEN 'ordinal_added' WHEN 6 THEN 'repeated_directional' WHEN 7 THEN 'placeholder_street_name' ELSE '' END AS flags FROM o""")
def street_words(spark, d):
    """Parts' names as streets: types and directions in their fields and inside the name, numbers, mounts, placeholders."""
    k = F.col("p_partkey")
    v, name = k % 8, F.upper("p_name")
    kind = F.element_at(F.array(*map(F.lit, ("ST", "AVE", "lane", "Ct", "PKWY", "Circle"))), (F.col("p_size") % 6 + 1).cast("int"))
    made = {
        "St_Name": F.when(v == 1, F.concat(F.lit("N "), name)).when(v == 2, F.concat(name, F.lit(" RD"))).when(v == 3, F.concat(name, F.lit("  SW "))).when(v == 4, (k % 90 + 1).cast("string")).when(v == 5, F.concat(F.lit("MT. "), name)).when(v == 7, F.concat(F.lit("UNNAMED "), name)).otherwise(name),
        "St_PosTyp": F.when(v == 2, " ").when(v == 4, "Street").otherwise(kind), "St_PreDir": F.when(v == 6, "W"), "St_PosDir": F.when(v == 6, "West"), "State": F.lit("KS"),
    }
    rows = read(spark, d, "part").select("p_partkey", *(clean(made.get(c, F.lit(None).cast("string"))).alias(c) for c in STREET_INPUTS))
    ruled = rows.withColumn("r", python_rules.street_rule()(*map(F.col, STREET_INPUTS)))
    return ruled.select("p_partkey", F.col("r.value").alias("street"), F.array_join("r.flags", ",").alias("flags"))


@query("""SELECT o_orderkey::BIGINT AS o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Apt ' || (o_custkey % 50)::VARCHAR || 'B' WHEN 1 THEN '#' || (o_custkey % 50)::VARCHAR WHEN 3 THEN 'Mill ' || substr(o_orderpriority, 3, 1) || ' House' WHEN 4 THEN 'Ste ' || (o_custkey % 50)::VARCHAR END AS value,
CASE o_orderkey % 6 WHEN 2 THEN 'unit_designator_only' WHEN 4 THEN 'building_not_in_unit' ELSE '' END AS flags FROM orders""")
def unit_words(spark, d):
    k, n = F.col("o_orderkey") % 6, (F.col("o_custkey") % 50).cast("string")
    unit = F.when(k == 0, F.concat(F.lit("apt "), n, F.lit("b"))).when(k == 1, F.concat(F.lit("#   "), n)).when(k == 2, " SUITE ").when(k == 4, F.concat(F.lit("ste. "), n)).when(k == 5, "N/A")
    building = F.when(k == 3, F.concat(F.lit("MILL "), F.lower(F.substring("o_orderpriority", 3, 1)), F.lit(" HOUSE"))).when(k == 4, "NORTH TOWER")
    rows = read(spark, d, "orders").select("o_orderkey", clean(unit).alias("unit"), clean(building).alias("building"))
    return rows.select("o_orderkey", python_rules.unit_rule()(F.col("unit"), F.col("building")).alias("r")).select("o_orderkey", "r.value", F.array_join("r.flags", ",").alias("flags"))


@query(f"""SELECT p_partkey::BIGINT AS p_partkey, CASE WHEN p_partkey % 6 < 4 THEN {_TITLE} WHEN p_partkey % 6 = 4 THEN 'Far ' || {_TITLE} END AS city, CASE p_partkey % 6 WHEN 3 THEN 'city_from_inc_muni,unknown_post_city_skipped' WHEN 4 THEN 'city_cased_by_rule,city_not_in_reference' WHEN 5 THEN 'no_city' ELSE '' END AS flags FROM part""")
def city_words(spark, d):
    """Parts' names as known places: in capitals, with a government or a ZIP code about them, misspelled beside the municipality, unknown, and none."""
    k, name = F.col("p_partkey") % 6, F.col("p_name")
    title = F.initcap(name)
    post = F.when(k == 0, F.upper(name)).when(k == 1, F.concat(F.lit("City of "), name)).when(k == 2, F.concat(F.upper(name), F.lit(" 67001"))).when(k == 3, F.concat(F.lit("X"), F.upper(name))).when(k == 4, F.concat(F.lit("FAR "), F.upper(name))).when(k == 5, "67501")
    part = read(spark, d, "part")
    known = place_names.load_places(part.select(F.lit("KS").alias("state"), title.alias("name"), F.lit("census_place").alias("source")).distinct())
    none = F.lit(None).cast("string")
    rows = part.select("p_partkey", clean(post).alias("post"), F.when(k == 3, F.upper(name)).alias("muni"))
    ruled = rows.withColumn("r", python_rules.city_rule(known)(F.col("post"), F.col("muni"), none, F.lit("KS"), none))
    return ruled.select("p_partkey", F.col("r.value").alias("city"), F.array_join(F.array_sort("r.flags"), ",").alias("flags"))
