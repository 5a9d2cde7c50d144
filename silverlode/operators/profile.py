"""Profiling: what a table looks like, in one scan for values and one shuffle for duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.predicates import any_null, count_where, percent
from silverlode.functions.rules import Rule, any_violated
from silverlode.functions.scalars import exact_mean
from silverlode.operators.dedup import weighted_rows


def melt(df: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row frame into one row per dict of expressions over it."""
    structs = [F.struct(*[e.alias(n) for n, e in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in each column."""
    return df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in df.columns])


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Column, NULL count and percentage, worst first; an empty table gives 0 percent."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[count_where(F.col(c).isNull()).alias(c) for c in columns],
    )
    report = melt(
        counted,
        [
            {
                "column": F.lit(c),
                "null_count": F.col(c),
                "null_percentage": F.coalesce(percent(F.col(c), F.col("_total")), F.lit(0.0)),
            }
            for c in columns
        ],
    )
    return report.orderBy(F.desc("null_percentage"), "column")


def null_alerts(df: DataFrame, columns: Sequence[str], limit_percent: float = 2.0) -> DataFrame:
    """NULL rate of the critical columns against a limit."""
    return null_report(df, columns).withColumn(
        "alert", F.col("null_percentage") > F.lit(limit_percent)
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum and mean of each numeric column, one row per column."""
    columns = list(columns or numeric_columns(df))
    wide = df.agg(
        *[
            e
            for c in columns
            for e in (
                F.min(c).cast("double").alias(f"{c}__min"),
                F.max(c).cast("double").alias(f"{c}__max"),
                exact_mean(c).alias(f"{c}__mean"),
            )
        ]
    )
    return melt(
        wide,
        [
            {
                "column": F.lit(c),
                "min_value": F.col(f"{c}__min"),
                "max_value": F.col(f"{c}__max"),
                "mean_value": F.col(f"{c}__mean"),
            }
            for c in columns
        ],
    )


def quality_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Totals of the quality report, from a single shuffle.

    Distinct rows are formed first with their weight; every other figure is a weighted sum over them,
    so the table is scanned once.
    """
    weight = F.col("_n")
    null, invalid = any_null(df.columns), any_violated(rules)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))

    totals = weighted_rows(df).agg(
        rows(F.lit(True)).alias("total_rows"),
        rows(null).alias("rows_any_null"),
        F.coalesce(F.sum(weight - 1), F.lit(0)).alias("duplicate_rows"),
        rows(invalid).alias("rows_any_invalid"),
        rows(null | invalid).alias("bad_rows"),
    )
    return totals.withColumn("clean_rows", F.col("total_rows") - F.col("bad_rows"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Uniqueness test: rows with a key, distinct keys, surplus."""
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    totals = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        count_where(F.col("_n") > 1).alias("n_repeated_keys"),
    )
    return totals.withColumn("passed", F.col("n_repeated_keys") == 0)


def not_null_test(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Not-null test: failures per column."""
    wide = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "column", "failures")
    return long.withColumn("passed", F.col("failures") == 0)


def partition_balance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per partition value, heaviest first."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *columns)
