"""Validation in four layers: reading, rules, aggregation, consumption."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions.contract import ErrorType
from silverlode.functions.predicates import count_where
from silverlode.functions.scalars import day_of, ntz
from silverlode.operators.route import ERROR_TYPE

CHECKS = {
    "type_error": "1_reading",
    "missing_critical": "2_rules",
    "business_rule": "2_rules",
    "indeterminate": "2_rules",
    "unreconciled": "3_aggregation",
    "empty": "4_consumption",
    "stale": "4_consumption",
    "absent_zones": "4_consumption",
}


def layered_report(
    bronze: DataFrame,
    silver: DataFrame,
    dead_letters: DataFrame,
    history: DataFrame,
    ts: str,
    zone: str,
    zones: DataFrame,
    zone_key: str,
    as_of: str,
    sla_days: int,
) -> DataFrame:
    """One row per layer and check of the stored layers: failures and whether the layer passes.

    The rows of both layers are reduced to one row per zone, which then meets the expected zones; every
    check is read off that. ``unreconciled`` compares an independent count of the raw rows with the rows
    in the two layers and the duplicates that ``history`` tells of.
    """
    accepted = silver.select(
        F.col(zone).alias("_zone"), F.lit(None).cast("string").alias("_verdict"), day_of(ts).alias("_day")
    )
    rejected = dead_letters.select(F.col(zone).alias("_zone"), F.col(ERROR_TYPE).alias("_verdict"), F.lit(None).cast("date").alias("_day"))
    verdict = F.col("_verdict")
    by_zone = accepted.unionAll(rejected).groupBy("_zone").agg(
        count_where(verdict == ErrorType.TYPE_ERROR.value).alias("type_error"),
        count_where(verdict == ErrorType.MISSING_CRITICAL.value).alias("missing_critical"),
        count_where(verdict == ErrorType.BUSINESS_RULE.value).alias("business_rule"),
        count_where(verdict == ErrorType.INDETERMINATE.value).alias("indeterminate"),
        count_where(verdict.isNull()).alias("clean"),
        F.count(F.lit(1)).alias("accounted"),
        F.max("_day").alias("newest"),
    )
    expected = zones.select(F.col(zone_key).alias("_expected")).distinct()
    matched = by_zone.join(expected, F.col("_zone") == F.col("_expected"), "full")
    sums = ("type_error", "missing_critical", "business_rule", "indeterminate", "clean", "accounted")
    seen = matched.agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max("newest").alias("newest"),
        count_where(
            F.col("_expected").isNotNull() & (F.coalesce("clean", F.lit(0)) == 0)
        ).alias("absent_zones"),
    )
    raw = bronze.agg(F.count(F.lit(1)).alias("raw"))
    copies = history.agg(F.sum("duplicate_rows").alias("accounted"))
    figures = seen.unionByName(raw, allowMissingColumns=True).unionByName(copies, allowMissingColumns=True)
    totals = figures.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*sums, "absent_zones", "raw")],
        F.max("newest").alias("newest"),
    )
    age = F.date_diff(ntz(as_of).cast("date"), F.col("newest"))
    counted = totals.withColumns(
        {
            "unreconciled": F.abs(F.col("raw") - F.col("accounted")),
            "empty": F.when(F.col("clean") > 0, 0).otherwise(1).cast("bigint"),
            "stale": F.when(age <= sla_days, 0).otherwise(1).cast("bigint"),
        }
    )
    layer = F.create_map(*[F.lit(x) for pair in CHECKS.items() for x in pair])
    return counted.select(*CHECKS).unpivot([], list(CHECKS), "check", "failures").select(
        layer[F.col("check")].alias("layer"),
        "check",
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )
