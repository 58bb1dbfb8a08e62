"""Words that stand behind Saint, derived from street names and place names by aggregation.

A word is a saint's if it stands behind Saint or Sainte spelled out, or behind ST at the beginning of the names of
several streets: of LEAST pairs of a state and a name at least. Words of routes, street types, directions and
extensions are none: there ST is State or Street.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import street

LEAST = 2
#: Most words that a dictionary held by every task may have.
MOST_WORDS = 100_000

NO_SAINTS = sorted(street.ANY_TYPE | street.ANY_DIRECTION | street.STATE_ROUTES | street.EXTENSIONS)


def words_of(name: Column) -> Column:
    """Upper-case words without points and apostrophes."""
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), "[.'’]", "")
    return F.split(F.upper(F.trim(F.regexp_replace(bare, r"\s+", " "))), " ")


def _behind(k: str) -> Column:
    """The word of w behind the k-th, if it may be a name."""
    after = F.expr(f"get(w, {k} + 1)")
    return F.when(after.rlike(r"\A\p{L}{2,}\z") & ~after.isin(*NO_SAINTS), F.lower(after))


def saint_words(streets: DataFrame, names: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, n_spelled, n_short): from streets (state, name) and place names (name).

    n_spelled counts pairs of a state and a name where the word stands behind Saint spelled out (of place names: names,
    and behind St. as well), n_short those that begin with ST and the word.
    """
    own = streets.select("state", words_of(F.col("name")).alias("w")).distinct()
    places = names.select(F.lit(None).cast("string").alias("state"), words_of(F.col("name")).alias("w")).distinct()

    def spelled(rows: DataFrame, *heads: str) -> DataFrame:
        every = rows.select("w", F.posexplode("w").alias("k", "head")).where(F.col("head").isin(*heads))
        return every.select(_behind("k").alias("word"), F.lit(1).alias("spelled"), F.lit(0).alias("short"))

    short = own.where("w[0] = 'ST' and size(w) > 1").select(_behind("0").alias("word"), F.lit(0).alias("spelled"), F.lit(1).alias("short"))
    found = spelled(own, "SAINT", "SAINTE").union(spelled(places, "SAINT", "SAINTE", "ST", "STE")).union(short).where("word is not null")
    counted = found.groupBy("word").agg(F.sum("spelled").alias("n_spelled"), F.sum("short").alias("n_short"))
    return counted.where((F.col("n_spelled") > 0) | (F.col("n_short") >= least))


def load_saints(words: DataFrame) -> frozenset[str]:
    """The words for the street rule, with those that need no evidence; their number is checked."""
    rows = words.select("word").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words stand behind Saint; raise the least number of streets")
    return street.SAINTS | {row.word for row in rows}
