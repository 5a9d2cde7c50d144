"""Column expressions used by cleaning and enrichment."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def ntz(value: str) -> Column:
    """A time-zone-free timestamp literal from 'yyyy-MM-dd HH:mm:ss'."""
    return F.lit(value).cast("timestamp_ntz")


def parse_timestamp(value: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to a time-zone-free timestamp; text that does not fit gives NULL."""
    return F.try_to_timestamp(value, F.lit(fmt)).cast("timestamp_ntz")


def snake_name(name: str) -> str:
    """VendorID -> vendor_id, PULocationID -> pu_location_id, Airport_fee -> airport_fee."""
    split_acronym = re.sub(r"([A-Z]{2,})([A-Z][a-z])", r"\1_\2", name)
    split_words = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", split_acronym)
    return re.sub(r"[^0-9a-z]+", "_", split_words.lower()).strip("_")


def money(column: str) -> Column:
    """Exact cents. A value that does not fit gives NULL instead of failing the job."""
    return F.col(column).try_cast(MONEY)


EXACT = "decimal(38,10)"
#: Values nearer to zero than this are added up by themselves, SHIFT times as large.
TINY, SHIFT = 1e-5, 1e20


def exact_sum(column: str | Column) -> Column:
    """Sum that does not depend on the order of the rows: in decimal, to ten places.

    Values below TINY are summed apart, to thirty places, so that a column of small numbers keeps its
    digits. Values of 10 ** 28 and more, and smaller ones than 10 ** -30, are added up as doubles, so
    none is lost. A sum that leaves the range of the decimal fails the job.
    """
    value = F.col(column) if isinstance(column, str) else column
    double = value.cast("double")
    tiny = (F.abs(double) < F.lit(TINY)) & (double != 0)
    shifted = F.when(tiny, (double * F.lit(SHIFT)).try_cast(EXACT))
    fits = F.when(~tiny | value.isNull(), value.try_cast(EXACT))
    parts = [
        F.sum(fits).cast("double"),
        F.sum(shifted).cast("double") / F.lit(SHIFT),
        F.sum(F.when(F.coalesce(fits, shifted).isNull() | (tiny & (shifted == 0)), double)),
    ]
    total = F.coalesce(parts[0], F.lit(0.0))
    for part in parts[1:]:
        total = F.when(part.isNull(), total).otherwise(total + part)
    return F.when(F.coalesce(*parts).isNotNull(), total)


def exact_mean(column: str) -> Column:
    """Mean from the exact sum and the number of non-NULL values, all of which the sum holds."""
    return F.try_divide(exact_sum(column), F.count(column).cast("double"))


def to_utc(column: str, zone: str = "America/New_York") -> Column:
    """Wall-clock time of a zone to UTC wall-clock time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(column))


def duration_minutes(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end)) / F.lit(60.0)


def speed_per_hour(distance: str, start: str, end: str) -> Column:
    """Distance per hour; NULL for a duration of zero."""
    seconds = F.timestamp_diff("SECOND", F.col(start), F.col(end)).cast("double")
    return F.try_divide(F.col(distance) * F.lit(3600.0), seconds)


def day_of(column: str) -> Column:
    return F.to_date(F.col(column))


def month_start(column: str) -> Column:
    """First day of the month, computed on dates, hence free of the session time zone."""
    return F.trunc(F.to_date(F.col(column)), "month")


def week_start(column: str) -> Column:
    """Monday of the week, computed on dates, hence free of the session time zone."""
    return F.trunc(F.to_date(F.col(column)), "week")


def hashed(column: str | Column, salt: str | None = None) -> Column:
    """SHA-256 as hex; NULL stays NULL.

    Small integer ids can be found again by hashing them all; pass a secret salt for those.
    """
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.sha2(value if salt is None else F.concat(F.lit(salt), value), 256)


def truncated(column: str, length: int) -> Column:
    """Coarse code: the first characters only."""
    return F.substring(F.col(column).cast("string"), 1, length)
