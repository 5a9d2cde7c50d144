from __future__ import annotations

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from trip_rows import AS_OF, SCHEMA, frame, trip

from silverlode.functions.contract import (
    CRITICAL_COLUMNS,
    DEDUP_KEYS,
    FILL_DEFAULTS,
    TRIP_CONTRACT,
)
from silverlode.functions.rules import cleaning_rules, contract_rules
from silverlode.operators import route as routing
from silverlode.operators.clean import normalize_checked
from silverlode.operators.dedup import dedup


def routed(spark, df, **options):
    return routing.route(
        df, DEDUP_KEYS, CRITICAL_COLUMNS, FILL_DEFAULTS, cleaning_rules(AS_OF), AS_OF, **options
    )


def verdicts(result) -> dict:
    return {r.verdict: r.n for r in result.verdict_counts().collect() if r.n}


def test_null_in_a_rule_column_is_never_lost(spark):
    rows = [
        trip(trip_id=1, VendorID=1, trip_distance=None),
        trip(trip_id=2, VendorID=2, tpep_dropoff_datetime=None),
        trip(trip_id=3, VendorID=3),
    ]
    held = routed(spark, frame(spark, *rows))
    assert verdicts(held) == {"rule_indeterminate": 2, "silver": 1}
    messages = {r.trip_id: r["_error_message"] for r in held.dead_letters.collect()}
    assert messages == {1: "trip_distance_negative", 2: "dropoff_in_future"}
    passed = routed(spark, frame(spark, *rows), on_null="pass")
    assert verdicts(passed) == {"silver": 3}


def test_a_broken_rule_outweighs_an_undecided_one(spark):
    df = frame(spark, trip(trip_distance=None, fare_amount=-1.0))
    letters = routed(spark, df).dead_letters.collect()
    assert [(r["_error_type"], r["_error_message"]) for r in letters] == [
        ("business_rule_failed", "fare_amount_negative")
    ]


@pytest.mark.parametrize("column", CRITICAL_COLUMNS)
def test_critical_null_names_its_column(spark, column):
    letter = routed(spark, frame(spark, trip(**{column: None}))).dead_letters.first()
    assert letter["_error_type"] == "missing_critical_column"
    assert letter["_error_message"] == column
    assert letter["_failed_at"] == datetime.datetime(2024, 1, 1)


def test_defaults_are_filled_and_cost_points(spark):
    df = frame(spark, trip(passenger_count=None), trip(VendorID=2, trip_distance=0.0, fare_amount=0.0))
    rows = {r.VendorID: r for r in routed(spark, df).silver.collect()}
    assert (rows[1].passenger_count, rows[1].data_quality_score) == (1.0, 90)
    assert rows[2].data_quality_score == 90


def test_worst_score(spark):
    df = frame(spark, trip(tip_amount=None, trip_distance=0.0, fare_amount=0.0))
    assert routed(spark, df).silver.first().data_quality_score == 80


def test_rows_with_missing_critical_values_are_not_filled(spark):
    letter = routed(spark, frame(spark, trip(fare_amount=None, tip_amount=None))).dead_letters.first()
    assert letter.tip_amount is None


def test_survivor_is_the_same_on_every_layout(spark):
    rows = [trip(trip_id=i, payment_type=p) for i in (5, 3, 9) for p in (2, 1)]
    rows += [trip(trip_id=i, VendorID=None, tpep_dropoff_datetime=None) for i in (8, 7)]
    expected = {(3, 1, 6), (7, 1, 2)}
    for parts in (1, 2, 7):
        for order in (rows, rows[::-1]):
            kept = dedup(frame(spark, *order).repartition(parts), DEDUP_KEYS, copies="n")
            assert {(r.trip_id, r.payment_type, r.n) for r in kept.collect()} == expected


def test_dedup_by_order(spark):
    rows = [trip(trip_id=1, tip_amount=5.0), trip(trip_id=2, tip_amount=1.0)]
    assert dedup(frame(spark, *rows), DEDUP_KEYS, order=["tip_amount"]).first().trip_id == 2


def test_dedup_on_all_columns(spark):
    df = frame(spark, trip(), trip(), trip(trip_id=2))
    kept = dedup(df, df.columns, copies="n")
    assert sorted((r.trip_id, r.n) for r in kept.collect()) == [(1, 2), (2, 1)]


def test_validate_first_differs_only_on_copies(spark):
    rows = [trip(), trip(), trip(fare_amount=-1.0, VendorID=2), trip(fare_amount=-1.0, VendorID=2)]
    df = frame(spark, *rows)
    assert verdicts(routed(spark, df)) == {
        "duplicate": 2,
        "business_rule_failed": 1,
        "silver": 1,
    }
    assert verdicts(routed(spark, df, validate_first=True)) == {
        "duplicate": 1,
        "business_rule_failed": 2,
        "silver": 1,
    }


def test_unreadable_text_becomes_a_type_error_with_its_original(spark):
    df = frame(spark, trip(), trip(VendorID=2))
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).withColumn(
        "fare_amount", F.when(F.col("VendorID") == "2", "twelve").otherwise(F.col("fare_amount"))
    )
    result = routed(spark, normalize_checked(text, dict(df.dtypes)))
    assert verdicts(result) == {"type_error": 1, "silver": 1}
    letter = result.dead_letters.first()
    assert letter["_error_message"] == "fare_amount"
    assert '"fare_amount":"twelve"' in letter["_original_record"]
    assert result.silver.first().fare_amount == 12.5


def test_unreadable_rows_are_read_again_under_corrected_types(spark):
    df = frame(spark, trip(), trip(VendorID=2))
    types = dict(df.dtypes)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).withColumn(
        "trip_id", F.when(F.col("VendorID") == "2", "T-2").otherwise(F.col("trip_id"))
    )
    letters = routed(spark, normalize_checked(text, types)).dead_letters
    same_rules = routing.reprocess(
        letters, CRITICAL_COLUMNS, FILL_DEFAULTS, cleaning_rules(AS_OF), AS_OF
    )
    kept = same_rules.dead_letters.first()
    assert (kept["_error_type"], kept["_error_message"]) == ("type_error", "trip_id")
    assert '"trip_id":"T-2"' in kept["_original_record"]
    again = routed(spark, routing.reread(letters, {**types, "trip_id": "string"}))
    row = again.silver.first()
    assert (row.trip_id, row.VendorID, row.fare_amount) == ("T-2", 2, 12.5)
    assert verdicts(again) == {"silver": 1}


def test_corrupt_lines_are_read_again(spark):
    letters = spark.createDataFrame(
        [("schema_mismatch", "7,x", "f.csv"), ("business_rule_failed", None, "f.csv")],
        "_error_type string, _original_record string, _source_file string",
    )
    again = routing.reread(letters, {"a": "int", "b": "string"}).collect()
    assert [(r.a, r.b, r["_type_errors"], r["_source_file"]) for r in again] == [(7, "x", "", "f.csv")]


def test_reprocess_recovers_rows_under_new_rules(spark):
    df = frame(spark, trip(passenger_count=11.0), trip(VendorID=2, fare_amount=-1.0))
    again = routing.reprocess(
        routed(spark, df).dead_letters,
        CRITICAL_COLUMNS,
        FILL_DEFAULTS,
        cleaning_rules(AS_OF, passengers=(None, 11)),
        AS_OF,
    )
    assert [r.VendorID for r in again.silver.collect()] == [1]
    assert [r.VendorID for r in again.dead_letters.collect()] == [2]


def test_warnings_do_not_reject(spark):
    contract = TRIP_CONTRACT.restricted_to(frame(spark, trip()).columns)
    df = frame(spark, trip(total_amount=1500.0), trip(VendorID=2, store_and_fwd_flag="X"))
    result = routing.route(
        df, DEDUP_KEYS, CRITICAL_COLUMNS, FILL_DEFAULTS, contract_rules(contract), AS_OF
    )
    assert verdicts(result) == {"silver": 1, "business_rule_failed": 1}
    assert result.dead_letters.first()["_error_message"] == "store_and_fwd_flag_domain"


def test_empty_input(spark):
    result = routed(spark, frame(spark, trip()).where("false"))
    metrics = result.metrics().first()
    assert (metrics.input_rows, metrics.dlq_rows, metrics.failure_rate) == (0, 0, 0.0)
    assert result.silver.count() == 0


def test_option_is_checked(spark):
    with pytest.raises(ValueError):
        routed(spark, frame(spark, trip()), on_null="ignore")


NUMBER = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 1.0, 7.0, 10.0, 11.0]))
TIME = st.one_of(
    st.none(),
    st.sampled_from([datetime.datetime(2023, 5, d) for d in (1, 2)] + [datetime.datetime(2025, 1, 1)]),
)
ROW = st.fixed_dictionaries(
    {
        "tpep_pickup_datetime": TIME,
        "tpep_dropoff_datetime": TIME,
        "passenger_count": NUMBER,
        "trip_distance": NUMBER,
        "fare_amount": NUMBER,
        "tip_amount": NUMBER,
        "total_amount": NUMBER,
        "PULocationID": st.one_of(st.none(), st.just(1)),
    }
)


def by_hand(row: dict) -> str:
    """The verdict of one row, decided by plain Python."""
    if any(row[c] is None for c in CRITICAL_COLUMNS):
        return "missing_critical_column"
    passengers = 1.0 if row["passenger_count"] is None else row["passenger_count"]
    tip = 0.0 if row["tip_amount"] is None else row["tip_amount"]
    now = datetime.datetime.fromisoformat(AS_OF)
    pickup, dropoff = row["tpep_pickup_datetime"], row["tpep_dropoff_datetime"]
    distance = row["trip_distance"]
    if (
        row["fare_amount"] < 0
        or row["total_amount"] < 0
        or tip < 0
        or passengers <= 0
        or passengers > 10
        or pickup > now
        or (distance is not None and distance < 0)
        or (dropoff is not None and (dropoff > now or dropoff < pickup))
    ):
        return "business_rule_failed"
    return "rule_indeterminate" if distance is None or dropoff is None else "silver"


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(ROW, min_size=1, max_size=40))
def test_verdicts_match_plain_python(spark, rows):
    full = [trip(trip_id=i, VendorID=i, **r) for i, r in enumerate(rows)]
    result = routed(spark, spark.createDataFrame(full, SCHEMA))
    found = {
        r.trip_id: r["_error_type"] or "silver"
        for r in result.rows.select("trip_id", "_error_type").collect()
    }
    assert found == {r["trip_id"]: by_hand(r) for r in full}
    metrics = result.metrics().first()
    assert metrics.input_rows == metrics.silver_rows + metrics.dlq_rows + metrics.duplicate_rows


def test_conservation_on_the_whole_table(spark, small):
    from silverlode.plans.inputs import routed_trips, trips

    result = routed_trips(spark, small)
    assert sum(verdicts(result).values()) == trips(spark, small).count()
    ids = [c for c in ("trip_id", "payment_type", "VendorID", "total_amount")]
    both = result.silver.select(*ids).intersect(result.dead_letters.select(*ids))
    assert both.count() == 0


@pytest.mark.parametrize("hot", ["third", "all"])
def test_hot_key_is_merged_before_the_shuffle(spark, hot):
    """A key with a third of the rows, or all of them, reaches the reducer as one row per task."""
    n = 30_000
    key = F.when(F.lit(hot == "all") | (F.col("id") % 3 == 0), 0).otherwise(F.col("id"))
    df = spark.range(0, n, 1, 6).select(key.alias("k"), F.col("id").alias("v"))
    kept = dedup(df, ["k"], copies="n")
    rows = {r.k: (r.v, r.n) for r in kept.collect()}
    assert rows[0] == (0, n if hot == "all" else n // 3)
    assert sum(c for _, c in rows.values()) == n
    assert "partial_min" in kept._jdf.queryExecution().executedPlan().toString()
