"""All registered queries."""

from __future__ import annotations

from silverlode.plans import (  # noqa: F401
    clean_queries,
    gold_queries,
    governance_queries,
    lake_queries,
    layer_queries,
    profile_queries,
    rule_queries,
    source_queries,
)
from silverlode.plans.registry import QUERIES, QueryFunction


def queries() -> dict[str, QueryFunction]:
    return {name: q.run for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle for name, q in QUERIES.items() if q.oracle}
