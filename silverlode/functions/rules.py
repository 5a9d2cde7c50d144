"""Validation rules as data.

A rule's condition says when a row is *wrong*. Where an operand is NULL the condition is NULL, and
what then happens to the row is decided by the router, never by an accidental filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.functions.contract import Contract, Severity
from silverlode.functions.predicates import any_of, holds
from silverlode.functions.scalars import ntz


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Column
    severity: Severity = Severity.CRITICAL

    @property
    def violated(self) -> Column:
        return holds(self.condition)

    @property
    def undecided(self) -> Column:
        return self.condition.isNull()


def _no_number(column: str) -> Column:
    """NaN or infinity: Spark orders NaN above all numbers."""
    return F.col(column) >= F.lit(float("inf"))


def negative(column: str) -> Rule:
    """Below zero, or no finite number at all."""
    return Rule(f"{column}_negative", (F.col(column) < 0) | _no_number(column))


def zero(column: str) -> Rule:
    return Rule(f"{column}_zero", F.col(column) == 0)


def above(column: str, limit: float, severity: Severity = Severity.CRITICAL) -> Rule:
    return Rule(f"{column}_gt_{limit:g}", F.col(column) > limit, severity)


def below(column: str, limit: float) -> Rule:
    """Below a limit, or no finite number at all."""
    return Rule(f"{column}_lt_{limit:g}", (F.col(column) < limit) | _no_number(column))


def not_positive(column: str) -> Rule:
    """Zero or less; fractions above zero pass."""
    return Rule(f"{column}_low", F.col(column) <= 0)


def fewer_than(column: str, minimum: float) -> Rule:
    return Rule(f"{column}_low", F.col(column) < minimum)


def in_future(column: str, label: str, as_of: str) -> Rule:
    return Rule(f"{label}_in_future", F.col(column) > ntz(as_of))


def before_cutoff(column: str, label: str, cutoff: str) -> Rule:
    return Rule(f"{label}_before_cutoff", F.col(column) < ntz(cutoff))


def ends_before_start(start: str, end: str, name: str) -> Rule:
    """Decided only where both ends are known; elsewhere not violated."""
    return Rule(name, holds(F.col(end) < F.col(start)))


def not_null(column: str) -> Rule:
    return Rule(f"{column}_null", F.col(column).isNull())


def in_domain(column: str, values: Sequence[str]) -> Rule:
    return Rule(f"{column}_domain", ~F.col(column).isin(*values))


def cleaning_rules(as_of: str, passengers: tuple[float | None, float] = (None, 10)) -> list[Rule]:
    """The rules that decide whether a trip may enter the clean layer.

    ``passengers`` is the least and the greatest number; without a least one it must be above zero.
    """
    low, high = passengers
    return [
        negative("fare_amount"),
        negative("trip_distance"),
        negative("total_amount"),
        negative("tip_amount"),
        not_positive("passenger_count") if low is None else fewer_than("passenger_count", low),
        above("passenger_count", high),
        in_future("tpep_pickup_datetime", "pickup", as_of),
        in_future("tpep_dropoff_datetime", "dropoff", as_of),
        ends_before_start(
            "tpep_pickup_datetime", "tpep_dropoff_datetime", "dropoff_before_pickup"
        ),
    ]


def profiling_rules(as_of: str, cutoff: str) -> list[Rule]:
    """The thirteen value checks of the quality report."""
    return [
        negative("trip_distance"),
        negative("fare_amount"),
        negative("total_amount"),
        negative("tip_amount"),
        zero("trip_distance"),
        zero("fare_amount"),
        zero("total_amount"),
        above("passenger_count", 10),
        in_future("tpep_pickup_datetime", "pickup", as_of),
        in_future("tpep_dropoff_datetime", "dropoff", as_of),
        before_cutoff("tpep_pickup_datetime", "pickup", cutoff),
        before_cutoff("tpep_dropoff_datetime", "dropoff", cutoff),
        ends_before_start(
            "tpep_pickup_datetime", "tpep_dropoff_datetime", "dropoff_before_pickup"
        ),
    ]


def null_rules(contract: Contract) -> list[Rule]:
    return [not_null(f.name) for f in contract.fields if not f.nullable]


def money_rules(contract: Contract) -> list[Rule]:
    return [negative(f.name) for f in contract.fields if f.monetary]


def minimum_rules(contract: Contract) -> list[Rule]:
    """Lower bounds of the fields that are not money."""
    return [
        below(f.name, f.minimum)
        for f in contract.fields
        if f.minimum is not None and not f.monetary
    ]


def domain_rules(contract: Contract) -> list[Rule]:
    return [in_domain(f.name, f.domain) for f in contract.fields if f.domain]


def order_rules(contract: Contract) -> list[Rule]:
    return [
        ends_before_start(start, end, f"{end}_before_{start}")
        for end, start in contract.not_before
    ]


def warning_rules(contract: Contract) -> list[Rule]:
    return [above(c, limit, Severity.WARNING) for c, limit in contract.warn_above.items()]


def contract_rules(contract: Contract) -> list[Rule]:
    """Every row-level rule a contract implies, critical ones first."""
    return [
        *null_rules(contract),
        *money_rules(contract),
        *minimum_rules(contract),
        *domain_rules(contract),
        *order_rules(contract),
        *warning_rules(contract),
    ]


def any_violated(rules: Sequence[Rule]) -> Column:
    return any_of(rule.violated for rule in rules)
