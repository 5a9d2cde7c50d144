from __future__ import annotations

import datetime

import pytest
from trip_rows import AS_OF, frame, trip

from silverlode.functions import rules
from silverlode.functions.contract import TRIP_CONTRACT, Severity
from silverlode.operators import validate

FUTURE = datetime.datetime(2024, 1, 2)
PAST = datetime.datetime(2008, 12, 31, 23, 59, 59)
CUTOFF = "2009-01-01 00:00:00"

CLEANING = [
    ("fare_amount_negative", {"fare_amount": -0.01}),
    ("trip_distance_negative", {"trip_distance": -1.0}),
    ("total_amount_negative", {"total_amount": -1.0}),
    ("tip_amount_negative", {"tip_amount": -1.0}),
    ("passenger_count_low", {"passenger_count": 0.0}),
    ("passenger_count_gt_10", {"passenger_count": 11.0}),
    ("dropoff_in_future", {"tpep_dropoff_datetime": FUTURE}),
    ("dropoff_before_pickup", {"tpep_dropoff_datetime": datetime.datetime(2023, 5, 1, 9, 59)}),
]
PROFILING = [
    ("trip_distance_zero", {"trip_distance": 0.0}),
    ("fare_amount_zero", {"fare_amount": 0.0}),
    ("total_amount_zero", {"total_amount": 0.0}),
    ("pickup_before_cutoff", {"tpep_pickup_datetime": PAST}),
]


def failed(spark, row, found):
    return validate.evaluate(frame(spark, row), found).first()["_failed_rules"]


def test_good_row_breaks_nothing(spark):
    assert failed(spark, trip(), rules.cleaning_rules(AS_OF)) == []
    assert failed(spark, trip(), rules.profiling_rules(AS_OF, CUTOFF)) == []


@pytest.mark.parametrize("name, change", CLEANING)
def test_each_cleaning_rule_fires_alone(spark, name, change):
    assert failed(spark, trip(**change), rules.cleaning_rules(AS_OF)) == [name]


@pytest.mark.parametrize("name, change", PROFILING)
def test_each_profiling_rule_fires_alone(spark, name, change):
    assert failed(spark, trip(**change), rules.profiling_rules(AS_OF, CUTOFF)) == [name]


def test_pickup_in_future_and_dropoff_before_cutoff(spark):
    late = trip(tpep_pickup_datetime=FUTURE, tpep_dropoff_datetime=None)
    assert failed(spark, late, rules.cleaning_rules(AS_OF)) == ["pickup_in_future"]
    early = trip(tpep_pickup_datetime=None, tpep_dropoff_datetime=PAST)
    assert failed(spark, early, rules.profiling_rules(AS_OF, CUTOFF)) == ["dropoff_before_cutoff"]


@pytest.mark.parametrize("value, wrong", [(10.0, False), (10.5, True), (1.0, False), (0.5, False)])
def test_passenger_edges(spark, value, wrong):
    assert bool(failed(spark, trip(passenger_count=value), rules.cleaning_rules(AS_OF))) is wrong


def test_passenger_range_is_a_parameter(spark):
    found = rules.cleaning_rules(AS_OF, passengers=(1, 6))
    assert failed(spark, trip(passenger_count=7.0), found) == ["passenger_count_gt_6"]


def test_exactly_now_is_not_the_future(spark):
    now = datetime.datetime(2024, 1, 1)
    row = trip(tpep_pickup_datetime=now, tpep_dropoff_datetime=now)
    assert failed(spark, row, rules.cleaning_rules(AS_OF)) == []


def test_counts_agree_with_rows(spark):
    rows = [trip(**change) for _, change in CLEANING] + [trip()]
    df = frame(spark, *rows)
    counts = {r.rule: r.n for r in validate.rule_counts(df, rules.cleaning_rules(AS_OF)).collect()}
    for rule in rules.cleaning_rules(AS_OF):
        assert counts[rule.name] == validate.violations(df, rule).count(), rule.name


def test_contract_rules_and_actions(spark):
    contract = TRIP_CONTRACT.restricted_to(frame(spark, trip()).columns)
    rows = [
        trip(store_and_fwd_flag="X"),
        trip(VendorID=0),
        trip(payment_type=0),
        trip(passenger_count=7.0),
        trip(trip_distance=301.0),
        trip(total_amount=1000.5),
        trip(fare_amount=None),
    ]
    report = {
        r.rule: r
        for r in validate.severity_report(frame(spark, *rows), rules.contract_rules(contract)).collect()
    }
    hit = {name for name, r in report.items() if r.n}
    assert hit == {
        "store_and_fwd_flag_domain",
        "VendorID_lt_1",
        "payment_type_lt_1",
        "passenger_count_gt_6",
        "trip_distance_gt_300",
        "total_amount_gt_1000",
        "fare_amount_null",
    }
    assert report["VendorID_lt_1"].action == "quarantine"
    assert report["trip_distance_gt_300"].severity == Severity.WARNING.value
    assert report["trip_distance_gt_300"].action == "log"
    assert report["tip_amount_null"].action == "none"


def test_missing_columns(spark):
    df = frame(spark, trip(), trip(fare_amount=None)).drop("tip_amount")
    with pytest.raises(ValueError, match="tip_amount"):
        validate.require_columns(df, TRIP_CONTRACT)
    report = {r["column"]: r for r in validate.missing_columns(df, TRIP_CONTRACT).collect()}
    assert (report["tip_amount"].missing, report["tip_amount"].rows_without_value) == (True, 2)
    assert (report["fare_amount"].missing, report["fare_amount"].rows_without_value) == (False, 1)


@pytest.mark.parametrize("value, positive, one", [(0.0, True, True), (0.5, False, True), (1.0, False, False)])
def test_the_least_number_is_named(spark, value, positive, one):
    row = trip(passenger_count=value)
    assert bool(failed(spark, row, [rules.not_positive("passenger_count")])) is positive
    assert bool(failed(spark, row, [rules.fewer_than("passenger_count", 1)])) is one
