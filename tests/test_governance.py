from __future__ import annotations

import datetime
import hashlib

import random
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from silverlode.functions.contract import TRIP_CONTRACT
from silverlode.functions.scalars import snake_name
from silverlode.operators import clean, gold, monitor, privacy, relations, schema
from silverlode.operators.privacy import PiiClass


def people(spark):
    return spark.createDataFrame(
        [("7", "12 Main Street", 1.5), (None, "5 Side Road", 2.5), ("8", None, 3.5)],
        "passenger_id string, address string, fare double",
    )


def test_hash_equals_hashlib_and_null_stays_null(spark):
    df = privacy.pseudonymize(people(spark), ["passenger_id"])
    privacy.assert_no_raw_columns(df, ["passenger_id"])
    expected = [hashlib.sha256(b"7").hexdigest(), None, hashlib.sha256(b"8").hexdigest()]
    assert [r.passenger_id_hashed for r in df.collect()] == expected


def test_salt_changes_the_hash(spark):
    row = privacy.pseudonymize(people(spark), ["passenger_id"], salt="pepper").first()
    assert row.passenger_id_hashed == hashlib.sha256(b"pepper7").hexdigest()


def test_policy(spark):
    policy = {"passenger_id": PiiClass.HIGH, "address": PiiClass.MEDIUM, "fare": PiiClass.LOW}
    df = privacy.apply_policy(people(spark), policy, length=5)
    assert df.columns == ["passenger_id_hashed", "address", "fare"]
    assert df.first().address == "12 Ma" and df.first().fare == 1.5
    with pytest.raises(ValueError):
        privacy.apply_policy(people(spark), {"nobody": PiiClass.HIGH})


def test_leaks_are_found(spark):
    with pytest.raises(ValueError):
        privacy.assert_no_raw_columns(people(spark), ["passenger_id"])
    counts = {r.check: r.n for r in privacy.leak_counts(people(spark), {"street": "Street|Road"}).collect()}
    assert counts == {"passenger_id:street": 0, "address:street": 2}


def test_erasure_keeps_rows_without_a_subject(spark):
    listed = spark.createDataFrame([(7,)], "id bigint")
    kept = privacy.erase(people(spark), listed, "passenger_id", "id")
    assert sorted(str(r.passenger_id) for r in kept.collect()) == ["8", "None"]
    hashed = privacy.pseudonymize(people(spark), ["passenger_id"], salt="s")
    gone = privacy.erase(
        hashed, listed, "passenger_id_hashed", "id", hashed_with="s", is_hashed=True
    )
    assert gone.count() == 2


def test_large_lists_are_joined_by_shuffle_and_small_ones_broadcast(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    joined = relations.orphan_rows(lines, "l_orderkey", orders, "o_orderkey")
    assert "BroadcastHashJoin" in plan_of(joined, "simple")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = plan_of(relations.orphan_rows(lines, "l_orderkey", orders, "o_orderkey"), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_reference_report(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    states = {r.state: r.n for r in relations.reference_report(fact, "k", dim, "id").collect()}
    assert states == {"matched": 2, "orphan": 1, "null_key": 1}
    assert [tuple(r) for r in relations.orphan_keys(fact, "k", dim, "id").collect()] == [(9, 1)]
    enriched = relations.enrich(fact, "k", dim, "id", {"label": "name"})
    assert enriched.count() == 4
    missing = relations.absent_members(dim, "id", fact, "k").collect()
    assert [r.id for r in missing] == [2]


def test_facts_with_unknown_keys_stay(spark):
    fact = spark.createDataFrame([(1, 5.0), (9, 6.0)], "zone int, amount double")
    dim = relations.build_dimension(fact.where("zone = 1"), "zone", "zone", {})
    rows = relations.build_fact(fact, {"zone": ("pickup", dim)}, ["amount"]).orderBy("amount").collect()
    assert rows[0].pickup_key == hashlib.sha256(b"1").hexdigest()
    assert rows[1].pickup_key is None


def test_reconcile(spark):
    detail = spark.range(5)
    full = spark.createDataFrame([(2,), (3,)], "n bigint")
    assert relations.reconcile(detail, full, "n").first().passed
    assert not relations.reconcile(detail, full.where("n > 2"), "n").first().passed


def test_schema_changes(spark):
    old = {"a": "int", "b": "int", "c": "string"}
    new = {"a": "int", "b": "double", "d": "string"}
    found = schema.classify_changes(schema.schema_diff(spark, old, new)).collect()
    assert {r.column: (r.change, r.change_class) for r in found} == {
        "a": ("same", "unchanged"),
        "b": ("retyped", "breaking"),
        "c": ("removed", "breaking"),
        "d": ("added", "non_breaking"),
    }


def test_contract_drift(spark):
    df = spark.createDataFrame([("x",), ("3",)], "VendorID string")
    drift = {r.column: r for r in schema.schema_drift(df, TRIP_CONTRACT.types()).collect()}
    assert drift["VendorID"].change == "retyped"
    assert (drift["VendorID"].n_values, drift["VendorID"].n_unreadable) == (2, 1)
    assert drift["fare_amount"].change == "removed"


def test_contract_to_struct():
    struct = TRIP_CONTRACT.to_struct()
    assert len(struct) == 20 and struct.fieldNames()[0] == "VendorID"
    assert struct["tpep_pickup_datetime"].dataType.simpleString() == "timestamp_ntz"
    assert TRIP_CONTRACT.missing_from(["VendorID"]) == TRIP_CONTRACT.names[1:]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("VendorID", "vendor_id"),
        ("PULocationID", "pu_location_id"),
        ("RatecodeID", "ratecode_id"),
        ("Airport_fee", "airport_fee"),
        ("tpep_pickup_datetime", "tpep_pickup_datetime"),
    ],
)
def test_snake_name(name, expected):
    assert snake_name(name) == expected


def test_snake_case_refuses_clashes(spark):
    with pytest.raises(ValueError):
        clean.snake_case(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


@pytest.mark.parametrize(
    "rate, band",
    [
        (0.0, "normal"),
        (0.99, "normal"),
        (1.0, "warning"),
        (4.99, "warning"),
        (5.0, "urgent"),
        (10.0, "urgent"),
        (10.01, "halt"),
    ],
)
def test_failure_bands(spark, rate, band):
    assert spark.range(1).select(monitor.failure_band(F.lit(rate))).first()[0] == band


def test_run_alerts(spark):
    runs = spark.createDataFrame(
        [(15.0, 5.0), (15.1, 0.0), (1.0, 5.1)], "runtime_minutes double, failure_rate double"
    )
    assert [r.alert for r in monitor.run_alerts(runs).collect()] == [False, True, True]


def test_freshness_of_nothing_is_stale(spark):
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    row = monitor.freshness(empty, "ts", "2024-01-01 00:00:00", 24).first()
    assert row.newest is None and row.fresh is False


def test_arrival_deadline(spark):
    df = spark.createDataFrame([(datetime.date(2024, 12, 17),)], "d date")
    assert df.select(monitor.arrival_deadline(F.col("d"))).first()[0] == datetime.date(2025, 1, 5)


def test_revenue_drop_alert(spark):
    days = [(datetime.date(2024, 1, 1) + datetime.timedelta(i), 100.0) for i in range(8)]
    days.append((datetime.date(2024, 1, 9), 59.0))
    df = spark.createDataFrame(days, "day date, revenue double")
    rows = {r.day.day: r for r in gold.versus_trailing(df, "revenue").collect()}
    assert rows[1].trailing_mean is None and rows[1].alert is False
    assert rows[8].alert is False
    assert (rows[9].trailing_mean, rows[9].alert) == (100.0, True)


def test_samples_are_cut_before_the_shuffle(spark):
    kind = F.when(F.col("id") < 990, "hot").otherwise("cold")
    df = spark.range(1000).select(kind.alias("_error_type"), F.col("id"))
    top = monitor.samples_per_type(df, 3, ["id"])
    assert "row_number(), 3, Partial" in plan_of(top, "simple")
    assert [r.id for r in top.orderBy("id").collect()] == [0, 1, 2, 990, 991, 992]


def test_department_view_shows_only_its_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert gold.department_view(df, "finance_test", ["a", "c"]).columns == ["a", "c"]
    assert spark.sql("SELECT * FROM finance_test").columns == ["a", "c"]


@pytest.mark.parametrize("n", [1, 3, 2000])
def test_samples_of_any_number_are_the_first_ones(spark, n):
    df = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS _error_type")
    rows = monitor.samples_per_type(df, n, ["id"]).collect()
    for kind in "ab":
        own = sorted(r["rank"] for r in rows if r._error_type == kind)
        assert own == list(range(1, min(n, 2000 if kind == "a" else 4000) + 1))
        first = sorted((r.id for r in rows if r._error_type == kind))
        assert first == sorted(i for i in range(6000) if (i % 3 == 0) == (kind == "a"))[:n]


def test_a_large_sample_is_ranked_in_buckets_first(spark):
    df = spark.range(10).selectExpr("id", "CASE WHEN id < 9 THEN 'a' ELSE 'b' END AS _error_type")
    plan = plan_of(monitor.samples_per_type(df, 2000, ["id"]))
    assert "hashpartitioning(_error_type" in plan and "_bucket" in plan


def test_a_new_required_column_breaks_consumers(spark):
    diff = schema.schema_diff(spark, {"a": "int"}, {"a": "int", "b": "int", "c": "int"})
    found = {r.column: r.change_class for r in schema.classify_changes(diff, required=["b"]).collect()}
    assert found == {"a": schema.UNCHANGED, "b": schema.BREAKING, "c": schema.NON_BREAKING}


def test_a_repeated_dimension_key_does_not_multiply_facts(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, name string")
    rows = relations.enrich(fact, "k", dim, "id", {"label": "name"}).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 10, "a"), (2, 20, "c"), (3, 30, None)]
    keys = dim.selectExpr("concat('key', id) AS zone_key", "id AS zone_id")
    built = relations.build_fact(fact, {"k": ("zone", keys)}, ["v"]).orderBy("v").collect()
    assert [r.v for r in built] == [10, 20, 30] and [r.zone_key is None for r in built] == [False, False, True]


def test_known_dimensions_go_to_the_facts(spark, small):
    from silverlode.plans import catalog

    plan = plan_of(catalog.queries()["fact_trips"](spark, small), "simple")
    joins = [line for line in plan.splitlines() if "Join" in line]
    # the three dimensions; the fourth join builds the trips
    assert sum("BroadcastHashJoin" in line for line in joins) >= 3
    assert not any("SortMergeJoin [vendor" in line or "SortMergeJoin [VendorID" in line for line in joins)


@pytest.mark.parametrize("seed", range(4))
def test_codes_are_shared_by_enough_rows(spark, seed):
    pick = random.Random(seed)
    codes = ["".join(pick.choices("ab" if seed % 2 else "abcdef", k=pick.randint(0, 4))) for _ in range(150)] + [None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "id int, code string")
    shown = {r.id: r.code for r in privacy.generalise(df, "code", 8, 4).collect()}
    assert sorted(shown) == list(range(151)) and all((codes[i] or "").startswith(c) for i, c in shown.items())
    sizes = Counter(shown.values())
    assert min(sizes.values()) >= 8 and len(sizes) > 3


def test_fewer_rows_than_asked_show_nothing(spark):
    df = spark.createDataFrame([("abc",), ("abd",)], "code string")
    assert [r.code for r in privacy.generalise(df, "code", 3, 3).collect()] == ["", ""]
    assert privacy.generalise(df.where("false"), "code", 3, 3).count() == 0
