"""Raw rows to tagged points: every field rule, every decision as a flag, no row lost."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import rules
from waymark.functions.columns import clean
from waymark.functions.street import SAINTS
from waymark.operators import python_rules
from waymark.schema import POINT_COLUMNS

STREET_INPUTS = "St_PreMod St_PreDir St_PreTyp St_PreSep St_Name St_PosTyp St_PosDir St_PosMod State County".split()
UNIT_INPUTS = "Unit Building".split()
CITY_INPUTS = "Post_City Inc_Muni Uninc_Comm State County".split()


def degrees(text: Column) -> Column:
    """A plain decimal number as a double, else null."""
    return F.when(F.trim(text).rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"), F.trim(text).cast("double"))


def tagged_points(raw: DataFrame, known: Broadcast, saints: Collection[str] = SAINTS) -> DataFrame:
    """POINT_COLUMNS of every raw row. The first reason of house number, street and life cycle drops a row.

    No row is moved: rules in Python remember the combinations of cleaned inputs that a task has seen; the other
    rules are expressions.
    """
    inputs = sorted({*STREET_INPUTS, *UNIT_INPUTS, *CITY_INPUTS})
    own = raw.withColumns({f"{c}__c": clean(F.col(c)) for c in inputs})
    of = lambda columns: [F.col(f"{c}__c") for c in columns]
    own = own.withColumns({"street__": python_rules.street_rule(saints)(*of(STREET_INPUTS)), "unit__": python_rules.unit_rule()(*of(UNIT_INPUTS)), "city__": python_rules.city_rule(known)(*of(CITY_INPUTS))})
    own = own.withColumns({"number__": rules.housenumber(F.col("AddNum_Pre"), F.col("Add_Number"), F.col("AddNum_Suf")), "zip__": rules.postcode(F.col("Zip_Code"), F.col("State"))})
    no_street = F.when(F.col("street__.value").isNull(), F.element_at("street__.flags", 1))
    made = {
        "nad_uuid": F.col("UUID"), "nad_oid": F.col("OID_"), "lon": degrees(F.col("Longitude")), "lat": degrees(F.col("Latitude")),
        "addr_housenumber": F.col("number__.value"), "addr_street": F.col("street__.value"), "addr_unit": F.col("unit__.value"), "addr_city": F.col("city__.value"),
        "addr_state": F.col("State"), "addr_postcode": F.col("zip__.value"), "nad_source": F.col("NAD_Source"), "county": F.col("County"),
        "placement": F.col("Placement"), "date_update": F.col("DateUpdate"),
        "flags": F.array_sort(F.array_distinct(F.concat("street__.flags", "number__.flags", "unit__.flags", "city__.flags", "zip__.flags"))),
        "drop_reason": F.coalesce("number__.drop_reason", no_street, rules.lifecycle_drop(F.col("Lifecycle"))),
    }
    return own.select(*(made[name].alias(name) for name in POINT_COLUMNS))


def outcomes(points: DataFrame) -> DataFrame:
    """How many rows of each state and source were kept, or dropped for which reason."""
    return points.groupBy("addr_state", "nad_source", F.coalesce("drop_reason", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def flag_counts(points: DataFrame) -> DataFrame:
    return points.where("drop_reason is null").select("addr_state", "nad_source", F.explode("flags").alias("flag")).groupBy("addr_state", "nad_source", "flag").agg(F.count(F.lit(1)).alias("n"))


def unknown_cities(points: DataFrame) -> DataFrame:
    """Cities that no reference knows, most frequent first."""
    unknown = points.where(F.array_contains("flags", "city_not_in_reference"))
    return unknown.groupBy("addr_state", "addr_city").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "addr_state", "addr_city")


REPORTS = {"drops": outcomes, "flags": flag_counts, "cities_not_in_reference": unknown_cities}
