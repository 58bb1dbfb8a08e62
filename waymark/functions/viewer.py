"""What a viewer computes: extents on the globe, ratios in rounded figures, and an order of mixed digits and letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def least_extents(rings: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, west, east) from (by, west, east) of each ring: the least interval of longitudes around a group's rings.

    The circle is cut in its largest gap between rings, the first of equal ones; east is above 180 where the interval
    crosses that line. Rings that cover the circle are cut at -180.
    """
    order = Window.partitionBy(*by).orderBy("west", "east")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    own = rings.withColumns({"reached": F.max("east").over(before), "end": F.max("east").over(whole), "begin": F.min("west").over(whole)})
    gap = F.when(F.col("reached").isNull(), F.col("begin") + 360 - F.col("end")).otherwise(F.col("west") - F.col("reached"))
    cut = own.withColumns({"gap": gap, "to": F.coalesce("reached", "end")})
    best = cut.groupBy(*by).agg(F.max_by(F.struct("west", "to"), F.struct("gap", -F.col("west"))).alias("cut"), F.max("gap").alias("gap"))
    west, to = F.col("cut.west"), F.col("cut.to")
    closed = F.col("gap") <= 0
    return best.select(*by, F.when(closed, -180.0).otherwise(west).alias("west"), F.when(closed, 180.0).when(to < west, to + 360).otherwise(to).alias("east"))


def rough(value: Column) -> Column:
    """1.4, 8, 35, 260, 4100: one decimal below 2, else whole numbers of two figures."""
    step = F.pow(F.lit(10.0), F.greatest(F.lit(0), F.floor(F.log10(value)) - 1))
    return F.when(value < 2, F.round(value, 1)).otherwise(F.floor(value / step + 0.5) * step)


def rough_ratio(counted: Column, points: Column) -> Column:
    """struct<kind, figure>: none, even (within a tenth), more (times as many counted) or fewer (points for each counted)."""
    ratio = counted / points
    kind = F.when(counted == 0, "none").when((ratio >= 0.9) & (ratio <= 1.1), "even").when(ratio > 1.1, "more").otherwise("fewer")
    figure = F.when(counted == 0, None).when(ratio > 1.1, rough(ratio)).when(ratio < 0.9, rough(points / counted))
    return F.struct(kind.alias("kind"), figure.alias("figure"))


def natural_key(text: Column) -> Column:
    """An array to order by: runs of digits by their number, and before other characters; case does not matter. 10A is after 2."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    digits = lambda run: F.regexp_replace(run, "^0+(?=[0-9])", "")
    return F.transform(runs, lambda run: F.when(run.rlike("^[0-9]"), F.concat(F.lit("0"), F.lpad(F.length(digits(run)).cast("string"), 4, "0"), digits(run))).otherwise(F.concat(F.lit("1"), run)))
