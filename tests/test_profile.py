from __future__ import annotations

from conftest import plan_of
from trip_rows import AS_OF, frame, trip

import pytest

from silverlode.functions.rules import profiling_rules
from silverlode.operators import clean, dedup, profile, validate
from silverlode.plans.report import quality_report, render

CUTOFF = "2009-01-01 00:00:00"


def checks():
    return profiling_rules(AS_OF, CUTOFF)


def test_empty_table_gives_zeros(spark):
    empty = frame(spark, trip()).where("false")
    assert all(
        (r.null_count, r.null_percentage) == (0, 0.0) for r in profile.null_report(empty).collect()
    )
    summary = profile.quality_summary(empty, checks()).first()
    assert set(summary.asDict().values()) == {0}
    assert dedup.duplicate_summary(empty).first().duplicate_percent == 0.0
    assert {r.n for r in validate.rule_counts(empty, checks()).collect()} == {0}
    assert profile.uniqueness(empty, "trip_id").first().passed
    assert all(r.mean_value is None for r in profile.value_ranges(empty).collect())
    assert quality_report(empty, checks())["null_percentage"]["trip_id"] == 0.0


def test_null_report_is_sorted_worst_first(spark):
    df = frame(spark, trip(tip_amount=None, fare_amount=None), trip(tip_amount=None))
    top = profile.null_report(df).take(2)
    assert [(r.column, r.null_count, r.null_percentage) for r in top] == [
        ("tip_amount", 2, 100.0),
        ("fare_amount", 1, 50.0),
    ]


def test_summary_counts_a_bad_row_once(spark):
    rows = [trip(), trip(), trip(fare_amount=None, trip_distance=-1.0), trip(trip_distance=-1.0)]
    s = profile.quality_summary(frame(spark, *rows), checks()).first()
    assert s.asDict() == {
        "total_rows": 4,
        "rows_any_null": 1,
        "duplicate_rows": 1,
        "rows_any_invalid": 2,
        "bad_rows": 2,
        "clean_rows": 2,
    }


def test_uniqueness_ignores_missing_keys(spark):
    df = frame(spark, trip(), trip(), trip(trip_id=2), trip(trip_id=None), trip(trip_id=None))
    row = profile.uniqueness(df, "trip_id").first()
    assert (row.n_rows, row.n_distinct, row.n_repeated_keys, row.passed) == (3, 2, 1, False)


def test_report_and_operators_agree(spark, small):
    from silverlode.plans.inputs import trips
    from silverlode.plans.trips import AS_OF as TRIPS_AS_OF
    from silverlode.plans.trips import CUTOFF as TRIPS_CUTOFF

    df = trips(spark, small)
    found = profiling_rules(TRIPS_AS_OF, TRIPS_CUTOFF)
    report = quality_report(df, found, examples=2)
    summary = profile.quality_summary(df, found).first().asDict()
    assert {k: report[k] for k in summary} == summary
    counts = {r.rule: r.n for r in validate.rule_counts(df, found).collect()}
    assert report["checks"] == counts
    assert set(report["examples"]) == {name for name, n in counts.items() if n}
    assert f"duplicate rows: {summary['duplicate_rows']}" in render(report)


def test_summary_needs_one_shuffle_of_rows(spark, small):
    df = spark.read.parquet(f"{small}/orders.parquet")
    plan = plan_of(profile.quality_summary(df, []), "simple")
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_rule_counts_do_not_shuffle_rows(spark, small):
    df = frame(spark, trip())
    plan = plan_of(validate.rule_counts(df, checks()), "simple")
    assert "hashpartitioning" not in plan
    assert plan.count("Exchange SinglePartition") == 1


def test_fill_ignores_unknown_columns(spark):
    df = frame(spark, trip(tip_amount=None))
    assert clean.fill_defaults(df, {"tip_amount": 0.0, "nope": 1}).first().tip_amount == 0.0
    assert clean.fill_defaults(df, {"nope": 1}).first().tip_amount is None


def test_sample_of_zero_rows(spark):
    assert clean.sample_rows(frame(spark, trip()), 0).count() == 0


def test_sample_is_the_same_on_every_layout(spark):
    rows = [trip(trip_id=i) for i in range(50)]
    a = clean.sample_rows(frame(spark, *rows).repartition(5), 3, ["trip_id"]).collect()
    b = clean.sample_rows(frame(spark, *rows[::-1]).repartition(2), 3, ["trip_id"]).collect()
    assert [r.trip_id for r in a] == [r.trip_id for r in b] == [0, 1, 2]


def test_top_rows_are_cut_in_each_task(spark, small):
    df = spark.read.parquet(f"{small}/orders.parquet")
    assert "TakeOrderedAndProject" in plan_of(clean.sample_rows(df, 5), "simple")


@pytest.mark.parametrize(
    ("kind", "values", "mean"),
    [
        ("double", [0.004, 0.004], 0.004),
        ("double", [5.0, 1e17], 5e16),
        ("bigint", [10**17, 10**17 + 2], 1e17 + 1),
        ("double", [1e30, None, 3.0], 5e29),
        ("int", [1, 2, 4], 7 / 3),
        ("double", [], None),
    ],
)
def test_means_hold_all_values(spark, kind, values, mean):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    assert profile.value_ranges(df).first().mean_value == mean
