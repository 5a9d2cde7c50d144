"""The quality report: everything the profile operators say about a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions.predicates import any_null, count_where
from silverlode.functions.rules import Rule, any_violated
from silverlode.operators.dedup import duplicate_groups, weighted_rows
from silverlode.operators.validate import examples_per_rule
from silverlode.sinks.writers import cached


def value_profile(df: DataFrame, rules: Sequence[Rule]) -> dict:
    """One scan, no shuffle of rows: total, NULLs per column, rule counts, bad rows."""
    null, invalid = any_null(df.columns), any_violated(rules)
    row = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_where(null).alias("rows_any_null"),
        count_where(invalid).alias("rows_any_invalid"),
        count_where(null | invalid).alias("bad_rows"),
        F.struct(*[count_where(F.col(c).isNull()).alias(c) for c in df.columns]).alias("nulls"),
        F.struct(*[count_where(r.condition).alias(r.name) for r in rules]).alias("checks"),
    ).first()
    found = row.asDict(recursive=True)
    total = found["total_rows"]
    found["null_percentage"] = {
        c: n * 100.0 / total if total else 0.0 for c, n in found["nulls"].items()
    }
    found["clean_rows"] = total - found["bad_rows"]
    return found


def duplicate_profile(df: DataFrame, examples: int = 10) -> dict:
    """Distinct rows, surplus rows and the largest groups: two groupings of whole rows.

    They are two actions on purpose. Observing the totals while the groups are collected would count
    rows twice if a lost executor made that stage run again.
    """
    totals = weighted_rows(df).agg(
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    found = totals.first().asDict()
    found["largest_groups"] = [r.asDict() for r in duplicate_groups(df).limit(examples).collect()]
    return found


def quality_report(df: DataFrame, rules: Sequence[Rule], examples: int = 10) -> dict:
    """Profile, duplicates and a few example rows per rule; only figures and examples reach the driver.

    The source is read and parsed once and kept, on disk where memory ends, for the further passes.
    """
    with cached(df) as kept:
        report = value_profile(kept, rules) | duplicate_profile(kept, examples)
        report["examples"] = {}
        if examples:
            for row in examples_per_rule(kept, rules, examples).orderBy("rule", "rank").collect():
                found = row.asDict()
                report["examples"].setdefault(found.pop("rule"), []).append(found)
                del found["rank"]
    return report


def render(report: dict) -> str:
    """The report as text."""
    lines = ["NULL ANALYSIS"]
    worst_first = sorted(report["nulls"], key=lambda c: (-report["null_percentage"][c], c))
    lines += [f"{c}: {report['nulls'][c]} ({report['null_percentage'][c]:.2f}%)" for c in worst_first]
    lines += [f"rows with any NULL: {report['rows_any_null']}", "", "DUPLICATES"]
    lines += [
        f"total rows: {report['total_rows']}",
        f"distinct rows: {report['distinct_rows']}",
        f"duplicate rows: {report['duplicate_rows']}",
        "",
        "VALUE CHECKS",
    ]
    lines += [f"{name}: {n}" for name, n in sorted(report["checks"].items())]
    lines += [
        "",
        "SUMMARY",
        f"rows with any invalid value: {report['rows_any_invalid']}",
        f"bad rows (NULL or invalid): {report['bad_rows']}",
        f"clean rows: {report['clean_rows']}",
    ]
    return "\n".join(lines)
