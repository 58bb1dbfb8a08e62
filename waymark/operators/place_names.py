"""Spellings of places by vote among reference lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.places import SOURCES, Decision, Places
from waymark.operators.memo import apply_rule
from waymark.operators.python_rules import place_key

#: Most spellings that a dictionary held by every task may have; the country has some hundred thousand places.
MOST_SPELLINGS = 2_000_000


def without_descriptor(name: Column) -> Column:
    """A census name without brackets and the small words or CDP behind it; null for areas that are no places."""
    bare = F.trim(F.regexp_replace(name, r"\s*\(.*?\)", ""))
    none = bare.rlike(r"(^|\s)(CCD|UT)$") | bare.rlike(r"[0-9]") | bare.rlike(r"^County(\s|$)") | (bare == "")
    return F.when(~none, F.regexp_replace(bare, r"(?U)(?<=\S)(\s+(CDP|[^\p{Lu}\s]*\p{Ll}[^\p{Lu}\s]*))+$", ""))


def spellings(names: DataFrame) -> DataFrame:
    """From (state, name, source) to (state, key, name, n, hamlet, n_spellings): the most votes, then the source's rank, then the name win.

    A name's source is the first of its sources by alphabet; hamlet marks keys that one list alone knows.
    """
    distinct = apply_rule(names.select("state", "name", "source").distinct(), ["name"], place_key, "key")
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, SOURCES)), F.min("source")), F.lit(len(SOURCES) + 1))
    votes = distinct.groupBy("state", "key", "name").agg(F.count(F.lit(1)).alias("n"), rank.alias("rank"), F.bool_and(F.col("source") == "gnis").alias("hamlet"))
    best = votes.groupBy("state", "key").agg(F.min(F.struct((-F.col("n")).alias("less"), "rank", "name", "n")).alias("best"), F.bool_and("hamlet").alias("hamlet"), F.count(F.lit(1)).alias("n_spellings"))
    return best.select("state", "key", "best.name", "best.n", "hamlet", "n_spellings")


def conflicts(names: DataFrame) -> DataFrame:
    """(state, chosen, spellings) of keys with several spellings."""
    distinct = apply_rule(names.select("state", "name", "source").distinct(), ["name"], place_key, "key")
    votes = distinct.groupBy("state", "key", "name").agg(F.count(F.lit(1)).alias("n"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "n"))), lambda x: F.concat(x["name"], F.lit(" ("), x["n"].cast("string"), F.lit(")"))), "; ")
    listed = votes.groupBy("state", "key").agg(said.alias("spellings"), F.count(F.lit(1)).alias("k")).where("k > 1")
    return spellings(names).select("state", "key", F.col("name").alias("chosen")).join(listed, ["state", "key"]).select("state", "chosen", "spellings")


def load_places(names: DataFrame, decisions: Iterable[Decision] = ()) -> Broadcast:
    """The dictionary for tasks; its size is checked first."""
    best = spellings(names).select("state", "key", "name", "hamlet")
    rows = best.limit(MOST_SPELLINGS + 1).collect()
    if len(rows) > MOST_SPELLINGS:
        raise ValueError(f"more than {MOST_SPELLINGS} spellings; join them instead")
    return names.sparkSession.sparkContext.broadcast(Places.of(map(tuple, rows), decisions))
