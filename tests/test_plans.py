"""What no plan of any query may contain, with broadcasting by size switched off."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of

from silverlode.plans import catalog

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BroadcastExchange",
    "Python",
    "Pandas",
)


@pytest.fixture(scope="module")
def without_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, saved)


def single_partition_inputs(plan: str) -> list[str]:
    """The operator below each exchange that brings everything into one task."""
    lines = [line for line in plan.splitlines() if line.strip(" :+-*()0123456789")]
    return [
        re.sub(r"^[\s:+\-*()0-9]*", "", lines[i + 1]).split("(")[0].split(" ")[0]
        for i, line in enumerate(lines[:-1])
        if "Exchange SinglePartition" in line
    ]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan(without_broadcast, small, name):
    plan = plan_of(catalog.queries()[name](without_broadcast, small), "simple")
    assert [word for word in FORBIDDEN if word in plan] == []
    # One task may receive only partial aggregates, or the daily figures that a window over days needs.
    daily = name in ("revenue_vs_7d", "dlq_rate_vs_baseline")
    allowed = {"HashAggregate", "SortAggregate"} | ({"Project"} if daily else set())
    assert set(single_partition_inputs(plan)) <= allowed
