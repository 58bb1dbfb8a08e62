"""Driver-facing queries of outputs and readers, with their SQL: tiles, quoted text, viewer figures, closest names, borders."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark.functions import viewer
from waymark.operators import spatial
from waymark.operators.closest import closest_names
from waymark.plans.address_queries import located, place, query, read
from waymark.schema import RAW_COLUMNS
from waymark.sources import tile_archive
from waymark.sources.shared import shared_folder
from waymark.sources.text_release import read_text
from waymark.stages import outputs

_WORLD = "268435456.0::DOUBLE / 4"  # 2 ^ 14 tiles of 4096 units


@query(f"""WITH c AS (SELECT c_custkey AS k, c_mktsegment AS city, c_nationkey::VARCHAR AS unit, {place('c_custkey')} FROM customer WHERE c_acctbal >= 0),
u AS (SELECT k, city, unit, floor((lon + 180.0::DOUBLE) / 360.0::DOUBLE * ({_WORLD}))::BIGINT AS px, floor((0.5::DOUBLE - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi())) * ({_WORLD}))::BIGINT AS py FROM c),
z AS (SELECT k, city, unit, zoom, px >> (14 - zoom) AS px, py >> (14 - zoom) AS py FROM u, (SELECT unnest([10, 11, 12, 13, 14]) AS zoom)),
t AS (SELECT * FROM z QUALIFY zoom = 14 OR row_number() OVER (PARTITION BY zoom, px // 64, py // 64 ORDER BY k) = 1)
SELECT zoom::INT AS zoom, px // 4096 AS tile_x, py // 4096 AS tile_y, (px % 4096)::INT AS x, (py % 4096)::INT AS y, k::VARCHAR AS housenumber, city, unit FROM t""")
def vector_tiles(spark, d):
    """Customers written to a tile archive, and all points of all its tiles read back by its directories."""
    rows = located(read(spark, d, "customer"), "c_custkey")
    none = F.lit(None).cast("string")
    points = rows.select("lon", "lat", F.col("c_custkey").cast("string").alias("addr_housenumber"), none.alias("addr_street"), F.col("c_nationkey").cast("string").alias("addr_unit"), F.col("c_mktsegment").alias("addr_city"), F.lit(" ").alias("addr_state"), none.alias("addr_postcode"), F.when(F.col("c_acctbal") < 0, "duplicate").alias("drop_reason"), "c_custkey")
    target = f"{shared_folder(spark, 'archive')}/points.pmtiles"
    tile_archive.write_archive(points, target, F.col("c_custkey"))
    tag = lambda name: F.col("properties")[f"addr:{name}"].alias(name)
    return tile_archive.read_archive(spark, target).select("zoom", "tile_x", "tile_y", "x", "y", tag("housenumber"), tag("city"), tag("unit"))


@query("""SELECT p_partkey::VARCHAR AS id, CASE p_partkey % 5 WHEN 0 THEN replace(p_name, ' ', chr(10)) WHEN 1 THEN 'a "' || p_name || '", b' WHEN 2 THEN NULL WHEN 3 THEN chr(10) || p_type || chr(10) || chr(10) || '"' ELSE p_name END AS name, p_size::VARCHAR || '" pipe' AS size FROM part""")
def quoted_records(spark, d):
    """Parts as text whose quoted values hold line breaks, separators and quotes, written as lines and read in splits."""
    k, line = F.col("p_partkey"), F.lit("\n")
    name = F.when(k % 5 == 0, F.replace("p_name", F.lit(" "), line)).when(k % 5 == 1, F.concat(F.lit('a "'), "p_name", F.lit('", b'))).when(k % 5 == 3, F.concat(line, "p_type", line, line, F.lit('"'))).when(k % 5 == 4, F.col("p_name"))
    quoted = F.when((k % 5 == 4), name).otherwise(F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"')))
    record = F.concat_ws(",", k.cast("string"), F.coalesce(quoted, F.lit("")), F.concat(F.col("p_size").cast("string"), F.lit('" pipe')))
    folder = shared_folder(spark, "quoted")
    rows = read(spark, d, "part").select(record.alias("value"), F.pmod(F.xxhash64("p_partkey"), F.lit(4)).alias("file"))
    rows.repartition(4, "file").select("value").mapInArrow(_with_headers, "value string").write.text(folder)
    return read_text(spark, folder, ["id", "name", "size"], line_breaks=True)


def _with_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's file begins with a header."""
    first = True
    for batch in batches:
        values = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_pydict({"value": ["id,name,size", *values] if first else values})
        first = False


@query("""WITH r AS (SELECT c_nationkey AS g, ((c_custkey * 7919 % 3600) / 10.0::DOUBLE - 180.0::DOUBLE) AS west, (c_custkey % 7) * 1.5::DOUBLE AS wide FROM customer WHERE c_custkey % 25 < c_nationkey),
i AS (SELECT g, west, least(west + wide, 180.0::DOUBLE) AS east FROM r), o AS (SELECT g, west, max(east) OVER (PARTITION BY g ORDER BY west, east ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached, max(east) OVER (PARTITION BY g) AS top, min(west) OVER (PARTITION BY g) AS low FROM i),
c AS (SELECT g, west, coalesce(reached, top) AS till, CASE WHEN reached IS NULL THEN low + 360 - top ELSE west - reached END AS gap FROM o), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY g ORDER BY gap DESC, west) = 1)
SELECT g::BIGINT AS nation, CASE WHEN gap <= 0 THEN -180.0 ELSE west END AS west, CASE WHEN gap <= 0 THEN 180.0 WHEN till < west THEN till + 360 ELSE till END AS east FROM b""")
def least_extents(spark, d):
    """Intervals of longitude by nation: the least one around them all, across 180 degrees where that is shorter."""
    k = F.col("c_custkey")
    west = (k * 7919 % 3600) / F.lit(10.0) - 180.0
    rows = read(spark, d, "customer").where(k % 25 < F.col("c_nationkey")).select(F.col("c_nationkey").cast("long").alias("nation"), west.alias("west"), F.least(west + (k % 7) * 1.5, F.lit(180.0)).alias("east"))
    return viewer.least_extents(rows, ["nation"])


_ROUGH = "CASE WHEN {v} < 2 THEN round({v}, 1) ELSE floor({v} / pow(10, greatest(0, floor(log10({v})) - 1)) + 0.5) * pow(10, greatest(0, floor(log10({v})) - 1)) END"


@query(f"""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE o_orderkey % 977 * (o_orderkey % 13 + 1) END::DOUBLE AS n, (o_custkey % 400 + 1)::DOUBLE AS p FROM orders)
SELECT o_orderkey::BIGINT AS o_orderkey, CASE WHEN n = 0 THEN 'none' WHEN n / p BETWEEN 0.9 AND 1.1 THEN 'even' WHEN n / p > 1.1 THEN 'more' ELSE 'fewer' END AS kind, CASE WHEN n = 0 THEN NULL WHEN n / p > 1.1 THEN {_ROUGH.format(v='(n / p)')} WHEN n / p < 0.9 THEN {_ROUGH.format(v='(p / n)')} END AS figure FROM r""")
def rough_ratios(spark, d):
    k = F.col("o_orderkey")
    counted = F.when(k % 11 == 0, 0).otherwise(k % 977 * (k % 13 + 1)).cast("double")
    return read(spark, d, "orders").select("o_orderkey", viewer.rough_ratio(counted, (F.col("o_custkey") % 400 + 1).cast("double")).alias("r")).select("o_orderkey", "r.*")


@query("""WITH t AS (SELECT DISTINCT o_orderpriority AS street, (CASE o_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Apt ' ELSE '0' END) || (o_custkey % 37)::VARCHAR || (CASE o_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE 'b' END) AS unit FROM orders),
s AS (SELECT street, unit, list_transform(regexp_extract_all(lower(unit), '([0-9]+|[^0-9]+)'), lambda r: CASE WHEN regexp_matches(r, '^[0-9]') THEN '0' || lpad(length(regexp_replace(r, '^0+([0-9])', '\\1'))::VARCHAR, 4, '0') || regexp_replace(r, '^0+([0-9])', '\\1') ELSE '1' || r END) AS key FROM t)
SELECT street, unit, row_number() OVER (PARTITION BY street ORDER BY key, unit)::BIGINT AS place, count(*) OVER (PARTITION BY street)::BIGINT - 12 AS more FROM s QUALIFY place <= 12""")
def natural_order(spark, d):
    """The first twelve units of a street in the order of their numbers and letters."""
    k = F.col("o_custkey")
    unit = F.concat(F.when(k % 4 == 0, "").when(k % 4 == 1, "Apt ").otherwise("0"), (k % 37).cast("string"), F.when(k % 3 == 0, "").when(k % 3 == 1, "A").otherwise("b"))
    tags = read(spark, d, "orders").select(F.col("o_orderpriority").alias("street"), unit.alias("unit")).distinct().withColumn("key", viewer.natural_key(F.col("unit")))
    group = Window.partitionBy("street")
    return tags.withColumns({"place": F.row_number().over(group.orderBy("key", "unit")).cast("long"), "more": F.count(F.lit(1)).over(group) - 12}).where("place <= 12").drop("key")


@query()
def closest_streets(spark, d):
    """Names of parts with a letter left out, two swapped or a word changed, and the part's name that is closest; see tests/test_outputs.py."""
    k, name = F.col("p_partkey"), F.col("p_name")
    changed = F.when(k % 4 == 0, F.concat(F.substring(name, 1, 3), F.expr("substring(p_name, 5)"))).when(k % 4 == 1, F.concat(F.expr("substring(p_name, 2, 1)"), F.substring(name, 1, 1), F.expr("substring(p_name, 3)"))).when(k % 4 == 2, F.concat(F.lit("Zq "), F.element_at(F.split(name, " "), -1))).otherwise(F.concat(name, F.lit(" Way")))
    part = read(spark, d, "part")
    return closest_names(part.select(changed.alias("street")), part.select(name.alias("name")))


@query("""WITH p AS (SELECT o_orderkey, o_custkey % 101 AS i, o_orderkey % 4 AS j FROM orders),
q AS (SELECT o_orderkey, (i * 0.1)::DECIMAL(12,7) AS lon, (i * 0.03 + CASE j WHEN 1 THEN 0.0000001 WHEN 2 THEN -0.0000001 WHEN 3 THEN 5 ELSE 0 END)::DECIMAL(12,7) AS lat FROM p),
h AS (SELECT o_orderkey, lon >= 0 AND lat <= 3 AND 10 * lat >= 3 * lon AS a, lat >= 0 AND lon <= 10 AND 10 * lat <= 3 * lon AS b FROM q)
SELECT o_orderkey::BIGINT AS o_orderkey, CASE WHEN a THEN 'above' ELSE 'below' END AS region FROM h WHERE a OR b""")
def slanted_borders(spark, d):
    """Points on, a ten-millionth above and below, and far from the slanted border of two triangles: those on it are in both, and count once."""
    i, j = F.col("o_custkey") % 101, F.col("o_orderkey") % 4
    number = lambda text: text.cast("decimal(12,7)").cast("double")
    lat = i * F.lit(0.03).cast("decimal(12,7)") + F.when(j == 1, F.lit("0.0000001")).when(j == 2, F.lit("-0.0000001")).when(j == 3, F.lit("5")).otherwise(F.lit("0")).cast("decimal(12,7)")
    points = read(spark, d, "orders").select("o_orderkey", number(i * F.lit(0.1).cast("decimal(12,7)")).alias("lon"), number(lat).alias("lat"))
    ring = lambda *corners: [[{"x": float(x), "y": float(y)} for x, y in (*corners, corners[0])]]
    shapes = spark.createDataFrame([("above", ring((0, 0), (10, 3), (0, 3))), ("below", ring((0, 0), (10, 0), (10, 3)))], "region string, rings array<array<struct<x:double,y:double>>>")
    return spatial.points_in_polygons(points, shapes, "o_orderkey", "region", boundary=True)


@query("""WITH r AS (SELECT o_orderpriority AS g, o_orderstatus AS s, CASE WHEN o_orderkey % 3 = 0 THEN upper(o_comment) ELSE o_comment END AS name, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey % 5)::VARCHAR END AS num, (o_custkey % 50)::VARCHAR AS lon, (o_custkey % 20)::VARCHAR AS lat, CASE WHEN o_orderkey % 9 = 0 THEN '123' WHEN o_orderkey % 9 < 4 THEN '67001' END AS zip, (o_custkey % 300)::VARCHAR AS uid FROM (SELECT *, o_orderpriority || ' ' || o_orderstatus AS o_comment FROM orders))
SELECT g AS "State", s AS "NAD_Source", count(*)::BIGINT AS n_rows, count(*) FILTER (name = upper(name) AND regexp_matches(name, '[A-Za-z]'))::BIGINT AS street_name_all_caps, count(*) FILTER (num IS NULL)::BIGINT AS no_number, count(*) FILTER (num = '0')::BIGINT AS zero_number, count(*) FILTER (lon = '0' OR lat = '0')::BIGINT AS zero_coords, count(*) FILTER (NOT regexp_full_match(zip, '[0-9]{5}'))::BIGINT AS bad_zip, (count(*) - count(DISTINCT (lon, lat)))::BIGINT AS shared_coords, (count(*) - count(DISTINCT uid))::BIGINT AS repeated_uuid, max(lon::DOUBLE) AS max_lon FROM r GROUP BY ALL""")
def quality_report(spark, d):
    """The quality report of a raw table made of orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.concat_ws(" ", "o_orderpriority", "o_orderstatus")
    made = {"State": F.col("o_orderpriority"), "NAD_Source": F.col("o_orderstatus"), "St_Name": F.when(k % 3 == 0, F.upper(name)).otherwise(name), "Add_Number": F.when(k % 7 != 0, (k % 5).cast("string")), "Longitude": (c % 50).cast("string"), "Latitude": (c % 20).cast("string"), "Zip_Code": F.when(k % 9 == 0, "123").when(k % 9 < 4, "67001"), "UUID": (c % 300).cast("string")}
    raw = read(spark, d, "orders").select(*(made.get(n, F.lit(None).cast("string")).alias(n) for n in RAW_COLUMNS))
    return outputs.quality(raw).select("State", "NAD_Source", "n_rows", "street_name_all_caps", "no_number", "zero_number", "zero_coords", "bad_zip", "shared_coords", "repeated_uuid", "max_lon")
