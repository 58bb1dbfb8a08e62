"""Rules on distinct inputs, joined back without losing null inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def apply_rule(rows: DataFrame, inputs: Sequence[str], rule: Callable[..., Column], name: str) -> DataFrame:
    """Rows with the rule's result as a column; the rule sees each combination of inputs once.

    Worth it for rules that run Python: a table has far fewer combinations than rows. The result is joined by
    null-safe equality, which is planned as a hash join.
    """
    memo = rows.select(*inputs).distinct()
    memo = memo.select(*(memo[c].alias(f"{c}__in") for c in inputs), rule(*(memo[c] for c in inputs)).alias(name))
    same = reduce(lambda a, b: a & b, (rows[c].eqNullSafe(memo[f"{c}__in"]) for c in inputs))
    return rows.join(memo, same, "left").drop(*(f"{c}__in" for c in inputs))
