"""Operators over a list of rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions.contract import Contract, Severity
from silverlode.functions.predicates import count_where
from silverlode.functions.rules import Rule, any_violated


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that break one rule. The bare condition is used, so that it reaches the scan."""
    return df.where(rule.condition)


def evaluate(df: DataFrame, rules: Sequence[Rule], into: str = "_failed_rules") -> DataFrame:
    """Add the array of the names of the rules each row breaks."""
    hits = F.array(*[F.when(r.violated, F.lit(r.name)) for r in rules])
    return df.withColumn(into, F.array_compact(hits))


def invalid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.where(any_violated(rules))


def examples_per_rule(df: DataFrame, rules: Sequence[Rule], n: int) -> DataFrame:
    """The first ``n`` rows that break each rule, in one scan for all rules.

    Only violating rows are ranked, in two steps (see ``first_per_group``).
    """
    broken = evaluate(df, rules, "_rules").withColumn("rule", F.explode("_rules")).drop("_rules")
    return first_per_group(broken, "rule", n, df.columns)


def first_per_group(df: DataFrame, group: str, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of each group with their ``rank``.

    A group is dealt over as many buckets as there are shuffle partitions and ranked in each; only the
    first ``n`` of every bucket meet in one task, whatever ``n`` is.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    own = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order))
    few = dealt.withColumn("_own", own).where(F.col("_own") <= n).drop("_own", "_bucket")
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return few.withColumn("rank", place).where(F.col("rank") <= n)


def rule_counts_wide(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One column per rule: rows that break it. One pass for any number of rules."""
    return df.agg(*[count_where(r.condition).alias(r.name) for r in rules])


def rule_counts(df: DataFrame, rules: Sequence[Rule], label: str = "rule") -> DataFrame:
    """One row per rule: rows that break it. One pass for any number of rules."""
    return rule_counts_wide(df, rules).unpivot([], [r.name for r in rules], label, "n")


def severity_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: severity, violations, and what follows from them.

    A violated critical rule sends rows to quarantine, a violated warning is only logged.
    """
    severity = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.severity.value)])
    counted = rule_counts(df, rules).withColumn("severity", severity[F.col("rule")])
    action = (
        F.when(F.col("n") == 0, "none")
        .when(F.col("severity") == Severity.CRITICAL.value, "quarantine")
        .otherwise("log")
    )
    return counted.select("rule", "severity", "n", action.alias("action"))


def require_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Fail before the scan when a contract column is absent."""
    missing = contract.missing_from(df.columns)
    if missing:
        raise ValueError(f"{contract.dataset}: missing columns {missing}")
    return df


def missing_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per contract column: is it absent, and how many rows lack a value because of that."""
    absent = contract.missing_from(df.columns)
    lacking = [
        (F.count(F.lit(1)) if c in absent else count_where(F.col(c).isNull())).alias(c)
        for c in contract.names
    ]
    long = df.agg(*lacking).unpivot([], contract.names, "column", "rows_without_value")
    return long.withColumn("missing", F.col("column").isin(absent) if absent else F.lit(False))
