"""Address field rules as native expressions: each gives struct<value, drop_reason, flags>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.columns import clean

#: States whose ZIP codes begin with zero.
ZERO_ZIP_STATES = ("CT", "MA", "ME", "NH", "NJ", "PR", "RI", "VI", "VT")
#: Life-cycle states of addresses that are not in use.
INACTIVE = ("DORMANT", "DUBIOUS", "INACTIVE", "MOVED", "NOT ACTIVE", "PENDING", "POTENTIAL", "PREASSIGNED", "PRELIMINARY", "PROPOSED", "RETIRED", "TEMPORARY")
#: Prefixes of distance markers.
MILEPOSTS = ("milepost", "mile post", "mile marker", "mp", "mm")

RESULT = "struct<value:string,drop_reason:string,flags:array<string>>"


def _result(value: Column, drop: Column, flags: Column) -> Column:
    return F.struct(value.alias("value"), drop.alias("drop_reason"), flags.alias("flags"))


def housenumber(prefix: Column, number: Column, suffix: Column) -> Column:
    """Prefix, number and suffix as one house number, or the reason why there is none.

    A hyphen at the prefix's end pads the number to two digits; a prefix of up to six characters in one word is
    glued on, a longer one set apart; a suffix LOT is dropped with a flag, one that begins with . or - glued on.
    """
    parts = F.struct(*(F.coalesce(clean(part), F.lit("")).alias(name) for name, part in (("pre", prefix), ("num", number), ("suf", suffix))))
    # a lambda over one row binds the cleaned parts, which would else be made anew wherever they are named
    return F.element_at(F.transform(F.array(parts), lambda row: _housenumber(row.pre, row.num, row.suf)), 1)


def _housenumber(pre: Column, num: Column, suf: Column) -> Column:
    digits = F.when(num.rlike(r"\A[0-9]+\z"), F.regexp_replace(num, r"\A0+(?=[0-9])", "")).otherwise(num)
    lot = F.upper(suf) == "LOT"
    drop = (
        F.when(num == "", "no_housenumber")
        .when(F.lower(pre).isin(*MILEPOSTS), "milepost_address")
        .when((F.upper(suf) == "BLK") | (F.lower(pre) == "block"), "block_address")
        .when((F.length(pre) > 4) & ~pre.rlike("[0-9]"), "unparsed_housenumber")
        .when((pre == "") & digits.rlike(r"\A0*\z") & suf.rlike(r"(?U)\A\p{L}*\z"), "zero_housenumber")
    )
    body = (
        F.when(pre.endswith("-"), F.concat(pre, F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)))
        .when((F.length(pre) <= 6) & ~pre.contains(" "), F.concat(pre, digits))
        .otherwise(F.concat(pre, F.lit(" "), digits))
    )
    tail = F.when((suf == "") | lot, "").when(suf.rlike(r"\A[.-]"), suf).otherwise(F.concat(F.lit(" "), F.when(F.length(suf) <= 2, F.upper(suf)).otherwise(suf)))
    return _result(F.when(drop.isNull(), F.concat(body, tail)), drop, F.when(drop.isNull() & lot, F.array(F.lit("dropped_number_suffix"))).otherwise(F.array().cast("array<string>")))


def postcode(zip_code: Column, state: Column) -> Column:
    """Five digits from 00501 to 99950; nine are cut; four get their zero back where ZIP codes begin with it."""
    digits = F.regexp_replace(F.coalesce(clean(zip_code), F.lit("")), r"[\s-]", "")
    five = F.substring(digits, 1, 5)
    numeric = digits.rlike(r"\A[0-9]+\z")
    good = numeric & F.length(digits).isin(5, 9) & five.between("00501", "99950")
    padded = numeric & (F.length(digits) == 4) & F.coalesce(state, F.lit("")).isin(*ZERO_ZIP_STATES)
    nothing = (digits == "") | digits.rlike(r"\A0+\z")
    value = F.when(good, five).when(padded, F.concat(F.lit("0"), digits))
    flag = F.when(good, None).when(padded, "postcode_zero_restored").when(~nothing, "bad_postcode")
    return _result(value, F.lit(None).cast("string"), F.array_compact(F.array(flag)))


def lifecycle_drop(lifecycle: Column) -> Column:
    return F.when(F.upper(clean(lifecycle)).isin(*INACTIVE), "inactive_lifecycle")
