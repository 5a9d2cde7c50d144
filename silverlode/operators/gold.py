"""Aggregates by day and zone, and windows over daily figures.

The windows run without a partition key. Their input is one row per calendar day, so its size is bound
by the calendar and not by the data: a century has fewer than 37,000 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from silverlode.functions.predicates import count_where, percent
from silverlode.functions.scalars import EXACT, day_of, exact_mean, exact_sum


def daily(df: DataFrame, ts: str, measures: dict[str, Column]) -> DataFrame:
    """One row per day with the given aggregates."""
    return df.groupBy(day_of(ts).alias("day")).agg(*[e.alias(n) for n, e in measures.items()])


def daily_count(df: DataFrame, ts: str) -> DataFrame:
    return daily(df, ts, {"n": F.count(F.lit(1))})


def daily_revenue(df: DataFrame, ts: str, amount: str) -> DataFrame:
    return daily(df, ts, {"n": F.count(F.lit(1)), "revenue": exact_sum(amount)})


def daily_revenue_by_zone(df: DataFrame, ts: str, zone: str, amount: str) -> DataFrame:
    return df.groupBy(day_of(ts).alias("day"), F.col(zone).alias("zone")).agg(
        F.count(F.lit(1)).alias("trips"), exact_sum(amount).alias("revenue")
    )


def daily_failure(df: DataFrame, ts: str, failed: Column) -> DataFrame:
    return daily(df, ts, {"n": F.count(F.lit(1)), "failed": count_where(failed)})


def _last_days(days: int) -> Window:
    """The given number of rows before the current one."""
    return Window.orderBy("day").rowsBetween(-days, -1)


def versus_trailing(df: DataFrame, value: str, days: int = 7, drop_percent: float = 40.0) -> DataFrame:
    """Each day against the mean of the preceding days that have data; flags a drop.

    The mean is an exact decimal sum divided by the number of days.
    """
    w = _last_days(days)
    total = F.sum(F.col(value).cast(EXACT)).over(w).cast("double")
    mean = F.try_divide(total, F.count(value).over(w).cast("double"))
    limit = F.lit(1.0 - drop_percent / 100.0)
    return df.withColumn("trailing_mean", mean).withColumn(
        "alert", F.coalesce(F.col(value) < F.col("trailing_mean") * limit, F.lit(False))
    )


def day_over_day(df: DataFrame, value: str) -> DataFrame:
    previous = F.lag(value, 1).over(Window.orderBy("day"))
    return df.withColumn("previous", previous).withColumn(
        "delta", F.col(value) - F.col("previous")
    )


def daily_mean_shift(df: DataFrame, ts: str, column: str, limit_percent: float = 50.0) -> DataFrame:
    """Mean per day and whether it moved by more than the limit since the day before."""
    means = daily(df, ts, {"mean_value": exact_mean(column)})
    previous = F.lag("mean_value", 1).over(Window.orderBy("day"))
    moved = F.abs(F.col("mean_value") - F.col("previous")) > F.col("previous") * F.lit(
        limit_percent / 100.0
    )
    return means.withColumn("previous", previous).withColumn(
        "shifted", F.coalesce(moved, F.lit(False))
    )


def rate_versus_baseline(df: DataFrame, days: int = 7, factor: float = 2.0) -> DataFrame:
    """Failure rate per day against the pooled rate of the preceding days."""
    w = _last_days(days)
    base = percent(F.sum("failed").over(w), F.sum("n").over(w))
    return (
        df.withColumn("rate", percent(F.col("failed"), F.col("n")))
        .withColumn("baseline_rate", base)
        .withColumn(
            "alert",
            F.coalesce(F.col("rate") > F.col("baseline_rate") * F.lit(factor), F.lit(False)),
        )
    )


def rate_trend(df: DataFrame, days: int = 30) -> DataFrame:
    """Failure rate over the last days, the current one included."""
    w = Window.orderBy("day").rowsBetween(-(days - 1), 0)
    return df.withColumns(
        {
            "rows_in_window": F.sum("n").over(w),
            "failed_in_window": F.sum("failed").over(w),
            "trend_rate": percent(F.sum("failed").over(w), F.sum("n").over(w)),
        }
    )


def _median(values: Column) -> Column:
    """Median of a small array without NULLs; NULL for an empty one."""
    ordered = F.array_sort(values)
    size = F.size(values)
    low = F.try_element_at(ordered, F.floor((size + 1) / 2).cast("int"))
    high = F.try_element_at(ordered, F.floor(size / 2).cast("int") + 1)
    return F.when(size > 0, (low + high) / F.lit(2.0))


def versus_weekday(
    df: DataFrame, value: str, weeks: int = 8, least: int = 4, spread: float = 3.0, scale: float = 1.4826
) -> DataFrame:
    """Each day against the same weekday of the preceding weeks, by medians, which one bad day can't move.

    The input has one row per day. A day is flagged when it lies more than ``spread`` deviations from
    the median; the deviation is the median distance from it, times ``scale``, which makes it that of a
    normal distribution. With fewer than ``least`` days to compare nothing is flagged.
    """
    before = Window.partitionBy(F.dayofweek("day")).orderBy("day").rowsBetween(-weeks, -1)
    past = df.withColumn("_past", F.collect_list(F.col(value).cast("double")).over(before))
    seen = past.withColumn("baseline", _median(F.col("_past")))
    apart = F.transform("_past", lambda x: F.abs(x - F.col("baseline")))
    seen = seen.withColumn("deviation", _median(apart) * F.lit(scale))
    far = F.abs(F.col(value) - F.col("baseline")) > F.col("deviation") * F.lit(spread)
    return seen.withColumn("alert", F.coalesce(far & (F.size("_past") >= least), F.lit(False))).drop("_past")


def trips_per_subject(df: DataFrame, hashed_column: str) -> DataFrame:
    return df.groupBy(hashed_column).agg(F.count(F.lit(1)).alias("trips"))


def department_view(gold: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Register a view on an aggregate table that shows only some of its columns."""
    gold.select(*columns).createOrReplaceTempView(name)
    return gold.sparkSession.table(name)
