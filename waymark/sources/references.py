"""Reference lists of place names, each to (state, name, source)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.place_names import without_descriptor


def _table(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A delimited file with a header, all text, names and values trimmed."""
    rows = spark.read.options(header=True, inferSchema=False, **options).csv(path)
    return rows.select(*(F.trim(F.col(f"`{c}`")).alias(c.strip().removeprefix("﻿")) for c in rows.columns))


def read_gazetteer(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Census places or county subdivisions (USPS, NAME), without descriptors."""
    return _table(spark, path, sep="\t").select(F.col("USPS").alias("state"), without_descriptor(F.col("NAME")).alias("name"), F.lit(source).alias("source")).where("name is not null")


def state_codes(spark: SparkSession, path: str) -> DataFrame:
    """(code, state): the numbers of states and their abbreviations."""
    return _table(spark, path, sep="\t").select(F.substring("GEOID", 1, 2).alias("code"), F.col("USPS").alias("state")).distinct()


def populated_places(spark: SparkSession, path: str, codes: DataFrame) -> DataFrame:
    """(state, name, lat, lon) of populated places in a pipe-separated list without quotes."""
    rows = _table(spark, path, sep="|", quote="").where("feature_class = 'Populated Place'")
    return rows.join(F.broadcast(codes), rows.state_numeric == codes.code).select("state", F.col("feature_name").alias("name"), "prim_lat_dec", "prim_long_dec")


def read_hamlets(spark: SparkSession, path: str, codes: DataFrame) -> DataFrame:
    """Names that are in use; former places are marked as historical."""
    return populated_places(spark, path, codes).where(~F.contains("name", F.lit("(historical)"))).select("state", "name", F.lit("gnis").alias("source"))


def hamlet_points(spark: SparkSession, path: str, codes: DataFrame) -> DataFrame:
    """(state, name, lon, lat) of populated places with a position."""
    return populated_places(spark, path, codes).where("prim_lat_dec is not null and prim_lat_dec not in ('', '0')").select("state", "name", F.col("prim_long_dec").cast("double").alias("lon"), F.col("prim_lat_dec").cast("double").alias("lat"))


def read_labels(spark: SparkSession, path: str, codes: DataFrame) -> DataFrame:
    """Labels (fips, label) of items with a seven-digit place code; what follows a comma is left out."""
    rows = _table(spark, path).withColumn("digits", F.regexp_replace("fips", r"[^0-9]", "")).where(F.length("digits") == 7)
    return rows.join(F.broadcast(codes), F.substring("digits", 1, 2) == codes.code).select("state", F.trim(F.element_at(F.split("label", ","), 1)).alias("name"), F.lit("wikidata").alias("source"))


def all_names(*lists: DataFrame) -> DataFrame:
    """The union of the lists, each row once."""
    return reduce(lambda a, b: a.unionByName(b), lists).distinct()
