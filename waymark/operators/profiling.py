"""Profiles of tables: fill rates, common values, tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.columns import blank_to_null


def _names(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def fill_rates(rows: DataFrame, by: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows and the percentage of non-blank values of each column, in one pass."""
    filled = [F.round(F.lit(100.0) * F.count(blank_to_null(F.col(c).cast("string"))) / F.count(F.lit(1)), 1).alias(f"{c}_filled") for c in columns]
    return rows.groupBy(*_names(by)).agg(F.count(F.lit(1)).alias("n_rows"), *filled)


def long_values(rows: DataFrame, by: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, col, val) without nulls: one explode, no union of scans."""
    parts = F.array(*(F.struct(F.lit(c).alias("col"), blank_to_null(F.col(c).cast("string")).alias("val")) for c in columns))
    return rows.select(*_names(by), F.explode(parts).alias("x")).select(*_names(by), "x.col", "x.val").where("val is not null")


def top_values(rows: DataFrame, by: str | Sequence[str], columns: Sequence[str], k: int = 20) -> DataFrame:
    """The k most common values of each column in each group; ties alphabetically."""
    counted = long_values(rows, by, columns).groupBy(*_names(by), "col", "val").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*_names(by), "col").orderBy(F.desc("n"), F.asc("val"))
    return counted.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= k)


def end_tokens(rows: DataFrame, column: str, least: int) -> DataFrame:
    """How often tokens stand first and last in a column's texts, where at least so often."""
    tokens = F.split(F.lower(F.trim(column)), " +")
    ends = F.explode(F.array(F.struct(F.lit("first").alias("place"), F.element_at("t", 1).alias("token")), F.struct(F.lit("last").alias("place"), F.element_at("t", -1).alias("token"))))
    return rows.where(F.col(column).isNotNull()).select(tokens.alias("t")).select(ends.alias("x")).groupBy("x.place", "x.token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def repeats(rows: DataFrame, by: str | Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """(by, name): rows beyond the first of each combination of the columns; nulls are values. Combinations are counted before they meet."""
    each = rows.groupBy(*_names(by), *columns).agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(*_names(by)).agg((F.sum("n") - F.count(F.lit(1))).alias(name))
