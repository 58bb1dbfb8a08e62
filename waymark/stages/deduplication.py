"""Copies of an address near its best row are dropped as duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import whole_number
from waymark.operators import duplicates

# Words behind a county's name.
COUNTY_WORDS = "county|parish|borough|census area|municipality|city and borough|city"


def placement_rank(placement: Column) -> Column:
    return F.when(placement.startswith("Structure"), 1).when(placement.isin("Site", "Property Access"), 2).when(placement.startswith("Parcel"), 3).when(placement == "Linear Geocode", 5).otherwise(4)


def county_name(county: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(county, F.lit(""))), rf" ({COUNTY_WORDS})\z", "")


def deduplicated(points: DataFrame) -> DataFrame:
    """The points with drop_reason duplicate on copies, and the flag same_address_elsewhere where a key that ends with the city has far rows.

    Rows go through the windows whole and nothing is joined back, so rows that share an id stay as many as they are.
    Rows dropped before are groups of their own, spread by a hash of the row, and come out as they went in.
    """
    small = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    made = {
        "k_gone": F.when(F.col("drop_reason").isNotNull(), F.xxhash64("nad_oid", "lon", "lat", "addr_street")), "k_county": county_name(F.col("county")), "k_number": F.lower("addr_housenumber"), "k_street": F.lower("addr_street"),
        "k_unit": small("addr_unit"), "k_city": small("addr_city"), "k_rank": placement_rank(F.col("placement")), "k_id": whole_number(F.col("nad_oid")),
    }
    key = ["addr_state", "k_county", "k_number", "k_street", "k_unit", "k_gone"]
    order = [F.asc("k_rank"), F.desc_nulls_last("date_update"), F.asc_nulls_last("k_id"), F.asc("nad_oid")]
    own = duplicates.verdicts(points.withColumns(made), key, [*key, "k_city"], order)
    kept = F.col("k_gone").isNull()
    flagged = F.array_sort(F.concat("flags", F.array(F.lit("same_address_elsewhere"))))
    return own.withColumns({"drop_reason": F.when(kept & F.col("is_duplicate"), "duplicate").otherwise(F.col("drop_reason")), "flags": F.when(kept & F.col("elsewhere_wider"), flagged).otherwise(F.col("flags"))}).select(*points.columns)
