"""Rules written in Python as Arrow functions: each gives struct<value, flags>.

A task remembers the results of the inputs that it has seen, so a rule runs once per combination and task, where the
rows are: nothing is shuffled, and no combination, as that of nulls, is a hot key. What is remembered is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator

import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions import places, street, units

RESULT = T.StructType([T.StructField("value", T.StringType()), T.StructField("flags", T.ArrayType(T.StringType()))])


#: Combinations whose results a task remembers, some hundred bytes each.
REMEMBERED = 1 << 18


def arrow_rule(rule: Callable[..., tuple[str | None, list[str]]]) -> Callable[..., Column]:
    """The rule as a function of columns of text."""

    @F.pandas_udf(RESULT)
    def remembered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple, tuple] = {}
        for batch in batches:
            found = []
            for inputs in zip(*(batch[c] for c in batch.columns), strict=True):
                if inputs not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[inputs] = rule(*inputs)
                found.append(seen[inputs])
            yield pd.DataFrame(found, columns=["value", "flags"])

    return lambda *columns: remembered(F.struct(*(column.alias(f"c{k}") for k, column in enumerate(columns))))


def street_rule(saints: Collection[str] = street.SAINTS) -> Callable[..., Column]:
    """Of cleaned (pre_mod, pre_dir, pre_type, pre_sep, name, post_type, post_dir, post_mod, state, county)."""
    return arrow_rule(lambda *parts: street.street_name(*parts, saints=saints))


def unit_rule() -> Callable[..., Column]:
    """Of cleaned (unit, building)."""
    return arrow_rule(lambda unit, building: units.unit_value(unit, building))


def city_rule(known: Broadcast) -> Callable[..., Column]:
    """Of cleaned (post_city, inc_muni, uninc_comm, state, county); known holds Places."""
    return arrow_rule(lambda post, muni, comm, state, county: places.choose_city(post, muni, comm, state, known.value, county))


def _text(rule: Callable[..., str | None]) -> Callable[..., Column]:
    return F.udf(lambda *values: None if None in values else rule(*values), T.StringType(), useArrow=True)


def _number(rule: Callable[..., int]) -> Callable[..., Column]:
    return F.udf(lambda *values: None if None in values else int(rule(*values)), T.LongType(), useArrow=True)


place_key = _text(lambda name: places.place_key(name))
county_key = _text(lambda name: places.county_key(name))
polygon_city = _text(lambda name: places.polygon_city(name))
edit_distance = _number(lambda a, b: places.edit_distance(a, b))
scored_edits = _number(lambda a, b: places.scored_edits(a, b))
resembles = F.udf(lambda value, name: bool(value and places.resembles(value, name)), T.BooleanType(), useArrow=True)
close_enough = F.udf(lambda value, name, edits: places.close_enough(value, name, edits), T.BooleanType(), useArrow=True)
