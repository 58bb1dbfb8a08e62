"""Duplicate verdicts by ranked windows: a row near the best row of its key is a duplicate of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.columns import metres

NEAR_METRES = 100.0


def ranked(rows: DataFrame, key: Sequence[str], order: Sequence[Column], near: float = NEAR_METRES) -> DataFrame:
    """Adds copies, place, metres_off (from the best row), is_duplicate and elsewhere; rows need lon and lat.

    Verdicts are against the best row alone: two far rows next to each other do not collapse. elsewhere marks
    every row of a key that has any row farther than near. One shuffle on the key serves all windows.
    """
    whole, best = Window.partitionBy(*key), Window.partitionBy(*key).orderBy(*order)
    own = rows.withColumns({"copies": F.count(F.lit(1)).over(whole), "place": F.row_number().over(best).cast("long"), "lat__": F.first("lat").over(best), "lon__": F.first("lon").over(best)})
    own = own.withColumn("metres_off", metres(F.col("lat__"), F.col("lon__"), F.col("lat"), F.col("lon"))).drop("lat__", "lon__")
    own = own.withColumn("is_duplicate", (F.col("place") > 1) & (F.col("metres_off") <= near))
    return own.withColumn("elsewhere", F.max(F.col("metres_off") > near).over(whole))


def verdicts(rows: DataFrame, key: Sequence[str], wider: Sequence[str], order: Sequence[Column], near: float = NEAR_METRES) -> DataFrame:
    """Two passes: by key, then survivors by the wider key; rows keep their data and get is_duplicate, elsewhere and elsewhere_wider.

    elsewhere is the first pass's, elsewhere_wider the second's; duplicates have neither. wider begins with key, so
    the second pass's windows need no shuffle of their own and nothing is joined back: repeated ids stay as they are.
    """
    first = ranked(rows, key, order, near).drop("copies", "place", "metres_off").withColumnsRenamed({"is_duplicate": "first__", "elsewhere": "far__"})
    second = ranked(first, [*wider, "first__"], order, near).drop("copies", "place", "metres_off")
    gone = F.col("first__") | F.col("is_duplicate")
    return second.withColumns({"is_duplicate": gone, "elsewhere": F.col("far__") & ~gone, "elsewhere_wider": F.col("elsewhere") & ~gone}).drop("first__", "far__")


def after_first(rows: DataFrame, key: str, row_id: str, pieces: int = 32) -> DataFrame:
    """(row_id, is_duplicate): whether a row of the same key has a smaller id; ids are distinct, null keys are one key.

    Rows are moved once, by key and a piece of it, so that a key that very many rows share lies in several tasks; each
    piece's least id and count decide for all of them.
    """
    dealt = rows.select(row_id, F.coalesce(key, F.lit(b"")).alias("key__"), F.pmod(F.xxhash64(row_id), F.lit(pieces)).alias("piece__")).repartition("key__", "piece__")
    least = dealt.groupBy("key__", "piece__").agg(F.min(row_id).alias("low"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("key__")
    firsts = least.select("key__", "piece__", F.min("low").over(whole).alias("first__"), F.sum("n").over(whole).alias("n")).where("n > 1").drop("n")
    return dealt.join(firsts, ["key__", "piece__"], "left").select(row_id, F.coalesce(F.col(row_id) != F.col("first__"), F.lit(False)).alias("is_duplicate"))
