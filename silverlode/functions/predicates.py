"""Boolean building blocks with explicit NULL behaviour."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(conditions: Iterable[Column]) -> Column:
    """Disjunction; false for no condition at all."""
    return reduce(or_, conditions, F.lit(False))


def any_null(columns: Iterable[str]) -> Column:
    """True when at least one of the columns is NULL; never NULL itself."""
    return any_of(F.col(c).isNull() for c in columns)


def holds(condition: Column) -> Column:
    """Two-valued form of a condition: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def count_where(condition: Column) -> Column:
    """Rows on which the condition holds; 0 on an empty input."""
    return F.count_if(condition)


def names_where(flags: dict[str, Column], separator: str = ", ") -> Column:
    """Names whose flag holds, joined to one string in the order given."""
    return F.concat_ws(separator, *[F.when(flag, F.lit(name)) for name, flag in flags.items()])


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 as double; NULL when whole is 0."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
