"""All queries of the address engine, gathered from the query modules."""

from __future__ import annotations

from waymark.plans import address_queries, output_queries, rule_queries, stage_queries, word_queries  # noqa: F401

FLAGSHIP = "dedup_verdict"


def queries() -> dict:
    """Name to callable(spark, sf_dir)."""
    return dict(address_queries.QUERIES)  # the other modules add theirs to it


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL."""
    return dict(address_queries.SQL)
