"""The closest name by the ratio of matching blocks, as a join on pairs of letters.

The ratio of two texts of T letters together is 2 M / T, where M letters match in blocks. Between two blocks at least
one letter of either text is left over, and T - 2 M letters are left over in all, so the blocks are T - 2 M + 1 at most,
and the pairs of letters within them M less that number: 3 M - T - 1 or more. At a ratio of at least c that is
T (1.5 c - 1) - 1. Texts so share that many pairs of letters, or, where that is none, single letters. A text's rarest
grams, all but the ones that it may miss, therefore hold one of any partner's: candidates are found by these alone,
and then get the exact ratio. No pair above the cutoff is lost.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTOFF = 0.75


def shared_pairs(letters: Column | float, cutoff: float):
    """The least number of pairs of letters that texts of so many letters together share; zero or less: perhaps none."""
    return letters * (1.5 * cutoff - 1) - 1


def _grams(rows: DataFrame, text: str, cutoff: float) -> DataFrame:
    """(text, kind, gram, k, need): pairs of letters of each different text, numbered where one comes again, and for texts that may share none with a partner the letters."""
    own = rows.where(F.col(text) != "").select(text).distinct().withColumn("size", F.length(text))
    least = F.col("size") * (1 + cutoff / (2 - cutoff))  # letters of the text and its shortest partner
    own = own.withColumn("need", F.ceil(shared_pairs(least, cutoff) - 1e-9))
    pairs = F.when(F.col("size") > 1, F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda i: F.substring(F.col(text), i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    letters = F.when(F.col("need") < 1, F.array_remove(F.array_distinct(F.split(F.col(text), "")), "")).otherwise(F.array().cast("array<string>"))
    of = lambda kind, grams: F.transform(grams, lambda g: F.struct(F.lit(kind).alias("kind"), g.alias("gram")))
    every = own.select(text, F.greatest("need", F.lit(1)).alias("need"), F.posexplode(F.concat(of(2, pairs), of(1, letters))).alias("at", "g"))
    return every.select(text, "need", "g.kind", "g.gram", F.row_number().over(Window.partitionBy(text, "g.kind", "g.gram").orderBy("at")).alias("k"))


def _rarest(grams: DataFrame, often: DataFrame, text: str) -> DataFrame:
    """A text's grams but the need - 1 most frequent pairs, which it can do without."""
    order = Window.partitionBy(text, "kind").orderBy(F.desc("often"), "gram", "k")
    ranked = grams.join(often, ["kind", "gram", "k"]).withColumn("place", F.row_number().over(order))
    return ranked.where((F.col("kind") == 1) | (F.col("place") >= F.col("need"))).select(text, "kind", "gram", "k")


def closest_names(streets: DataFrame, names: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(street, closest): of names (name) the one of the largest ratio with each different street, at least cutoff; of equal ones the last by alphabet; null where there is none."""
    if not 2 / 3 < cutoff <= 1:
        raise ValueError("a cutoff of two thirds or less leaves texts without common pairs")
    a, b = _grams(streets, "street", cutoff), _grams(names, "name", cutoff)
    gram = ["kind", "gram", "k"]
    often = a.select(*gram).union(b.select(*gram)).groupBy(*gram).agg(F.count(F.lit(1)).alias("often"))
    pairs = _rarest(a, often, "street").join(_rarest(b, often, "name"), gram).select("street", "name").distinct()
    sizes = F.length("street") + F.length("name")
    fits = 2 * F.least(F.length("street"), F.length("name")) >= cutoff * sizes - 1e-9
    ranked = pairs.where(fits).withColumn("ratio", _ratio(cutoff)("name", "street")).where(F.col("ratio") >= cutoff)
    best = ranked.groupBy("street").agg(F.max(F.struct("ratio", "name")).alias("best"))
    return streets.select("street").distinct().join(best, "street", "left").select("street", F.col("best.name").alias("closest"))


def _ratio(cutoff: float):
    @F.pandas_udf("double")
    def ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        matcher = difflib.SequenceMatcher()
        for names, streets in pairs:
            found = []
            for name, street in zip(names, streets, strict=True):
                if matcher.b != street:
                    matcher.set_seq2(street)
                matcher.set_seq1(name)
                found.append(matcher.ratio() if matcher.real_quick_ratio() >= cutoff and matcher.quick_ratio() >= cutoff else 0.0)
            yield pd.Series(found, dtype="float64")

    return ratio
