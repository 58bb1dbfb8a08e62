"""Column expressions that the stages share; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRES_PER_DEGREE, KM_PER_DEGREE = 111_320.0, 111.2

#: Texts that stand for "nothing here".
PLACEHOLDERS = ("<null>", "n/a", "na", "none", "not applicable", "not stated", "null", "tbd", "unassigned", "unk", "unknown")


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def clean(column: Column) -> Column:
    """Collapses white space (non-breaking included); null where nothing but a placeholder or marks is left."""
    text = F.trim(F.regexp_replace(column, r"[\s ]+", " "))
    return F.when((text == "") | F.lower(text).isin(*PLACEHOLDERS) | ~text.rlike(r"(?U)\w"), None).otherwise(text)


def whole_number(column: Column) -> Column:
    """Text as a long, null where it isn't digits."""
    return F.when(column.rlike(r"\A-?[0-9]{1,18}\z"), column.cast("bigint"))


def metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlon = (lon2 - lon1) * F.cos(F.radians(lat1))
    return METRES_PER_DEGREE * F.sqrt((lat2 - lat1) * (lat2 - lat1) + dlon * dlon)


def kilometres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlon = (lon2 - lon1) * F.cos(F.radians(lat1))
    return KM_PER_DEGREE * F.sqrt((lat2 - lat1) * (lat2 - lat1) + dlon * dlon)


def flags(*conditions: tuple[Column, str]) -> Column:
    """Sorted distinct names of the conditions that hold."""
    named = F.array(*(F.when(condition, F.lit(name)) for condition, name in conditions))
    return F.array_sort(F.array_distinct(F.array_compact(named)))


def uuid_from(text: Column) -> Column:
    """An upper-case 8-4-4-4-12 form of the text's MD5."""
    digest = F.upper(F.md5(text))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, a, n) for a, n in cuts))


def single_origin(own: Column, other: Column) -> Column:
    """Which of two sources a region's points are from; below five in a hundred a source doesn't count."""
    total = own + other
    return F.when(total == 0, "none").when(20 * other < total, "own").when(20 * own < total, "other").otherwise("mixed")
