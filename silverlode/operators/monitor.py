"""Thresholds, alerts and triage on the output of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.predicates import count_where, percent
from silverlode.functions.scalars import ntz, week_start
from silverlode.operators.validate import first_per_group




def band_of(rate: float) -> str:
    """``failure_band`` of a figure that is at hand."""
    return "halt" if rate > 10.0 else "urgent" if rate >= 5.0 else "warning" if rate >= 1.0 else "normal"


def failure_band(rate: Column) -> Column:
    """Band of a failure rate in percent: below 1, from 1, from 5, above 10."""
    return (
        F.when(rate > 10.0, "halt")
        .when(rate >= 5.0, "urgent")
        .when(rate >= 1.0, "warning")
        .when(rate >= 0.0, "normal")
    )


def with_rate(df: DataFrame, failed: str, total: str) -> DataFrame:
    return df.withColumn("rate", F.coalesce(percent(F.col(failed), F.col(total)), F.lit(0.0)))


def dead_letter_alert(rate: Column, limit_percent: float = 1.0) -> Column:
    return rate > F.lit(limit_percent)


#: When a run deserves an alert.
MAX_MINUTES, MAX_FAILURE = 15.0, 5.0


def run_alerts(runs: DataFrame, max_minutes: float = MAX_MINUTES, max_failure: float = MAX_FAILURE) -> DataFrame:
    """Alerts on a run-metrics table with ``runtime_minutes`` and ``failure_rate``."""
    slow = F.col("runtime_minutes") > F.lit(max_minutes)
    failing = F.col("failure_rate") > F.lit(max_failure)
    return runs.withColumns(
        {"slow": slow, "failing": failing, "alert": slow | failing}
    )


def freshness(df: DataFrame, ts: str, as_of: str, sla_hours: float, by: str | None = None) -> DataFrame:
    """Newest value, its age in hours at ``as_of`` and whether that is within the SLA."""
    newest = F.max(ts).alias("newest")
    latest = df.groupBy(by).agg(newest) if by else df.agg(newest)
    micros = F.timestamp_diff("MICROSECOND", F.col("newest"), ntz(as_of)).cast("double")
    age = micros / F.lit(3600000000.0)
    return latest.withColumn("age_hours", age).withColumn(
        "fresh", F.coalesce(F.col("age_hours") <= F.lit(sla_hours), F.lit(False))
    )


def arrival_deadline(month: Column, day: int = 5) -> Column:
    """The day by which the file of a month must have arrived: a day of the following month."""
    return F.date_add(F.add_months(F.trunc(month, "month"), 1), day - 1)


def not_empty(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).withColumn("passed", F.col("n") > 0)


def triage(dead_letters: DataFrame) -> DataFrame:
    """Dead letters per error type, most frequent first."""
    return (
        dead_letters.groupBy("_error_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "_error_type")
    )


def samples_per_type(dead_letters: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows of each error type, ranked in two steps so that no type meets in one task."""
    return first_per_group(dead_letters, "_error_type", n, order)


def weekly_patterns(dead_letters: DataFrame, ts: str, kind: str) -> DataFrame:
    """Dead letters per week and kind."""
    return dead_letters.groupBy(week_start(ts).alias("week"), F.col(kind)).agg(
        F.count(F.lit(1)).alias("n")
    )


def rate_by(df: DataFrame, group: Column, name: str, failed: Column) -> DataFrame:
    """Total, failed, rate, band and alert for each group."""
    counts = df.groupBy(group.alias(name)).agg(
        F.count(F.lit(1)).alias("total"), count_where(failed).alias("failed")
    )
    rated = with_rate(counts, "failed", "total")
    return rated.withColumns(
        {"band": failure_band(F.col("rate")), "alert": dead_letter_alert(F.col("rate"))}
    )
