from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from silverlode.functions.contract import TRIP_CONTRACT
from silverlode.functions.rules import cleaning_rules
from silverlode.functions.scalars import hashed
from silverlode.operators.clean import normalize_checked
from silverlode.operators.privacy import PiiClass, assert_no_raw_columns
from silverlode.plans import pipeline
from silverlode.plans.inputs import routed_trips, trips
from silverlode.plans.trips import AS_OF
from trip_rows import GOOD

POLICY = {"passenger_id": PiiClass.HIGH, "driver_id": PiiClass.HIGH}


def layers_at(root) -> pipeline.Layers:
    return pipeline.Layers(
        f"{root}/silver", f"{root}/dead_letters", f"{root}/gold", f"{root}/metrics"
    )


@pytest.fixture(scope="module")
def done(spark, small, tmp_path_factory):
    layers = layers_at(tmp_path_factory.mktemp("lake"))
    metrics = pipeline.run(spark, trips(spark, small), layers, AS_OF, policy=POLICY)
    return layers, metrics


def test_observed_metrics_equal_what_was_written(spark, small, done):
    layers, metrics = done
    assert spark.read.parquet(layers.silver).count() == metrics["silver_rows"] == 4000
    assert spark.read.parquet(layers.dead_letters).count() == metrics["dlq_rows"] == 2000
    assert metrics["input_rows"] == 6242 and metrics["duplicate_rows"] == 242
    counted = routed_trips(spark, small).metrics().first().asDict()
    assert {k: metrics[k] for k in counted if k != "run_ts"} == {
        k: v for k, v in counted.items() if k != "run_ts"
    }


def test_layers_have_their_columns(spark, done):
    layers, _ = done
    silver = spark.read.parquet(layers.silver)
    assert_no_raw_columns(silver, ["passenger_id", "driver_id"])
    assert {"processing_timestamp", "data_quality_score", "passenger_id_hashed"} <= set(silver.columns)
    letters = spark.read.parquet(layers.dead_letters)
    assert {"_error_type", "_error_message", "_failed_at", "_source_file", "_original_record"} <= set(
        letters.columns
    )
    assert letters.where(F.col("_error_message").isNull()).count() == 0
    assert letters.select("year", "month", "day").distinct().count() == 1


def test_gold_reconciles(spark, done):
    layers, metrics = done
    gold = spark.read.parquet(layers.gold)
    assert gold.agg(F.sum("trips")).first()[0] == metrics["silver_rows"]
    assert gold.columns == ["day", "zone", "trips", "revenue", "year", "month"]


def test_a_second_run_gives_the_same_layers(spark, small, done, tmp_path):
    layers, _ = done
    again = layers_at(tmp_path)
    pipeline.run(spark, trips(spark, small).repartition(5), again, AS_OF, policy=POLICY)
    for a, b in ((layers.silver, again.silver), (layers.dead_letters, again.dead_letters)):
        left, right = spark.read.parquet(a), spark.read.parquet(b)
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_metrics_history_grows(spark, small, tmp_path):
    layers = layers_at(tmp_path)
    for _ in range(2):
        pipeline.run(spark, trips(spark, small), layers, AS_OF)
    history = spark.read.parquet(layers.metrics)
    assert history.count() == 2
    assert history.select("input_rows").distinct().count() == 1


def test_dead_letters_move_when_a_rule_changes(spark, small, tmp_path):
    layers = pipeline.Layers(f"{tmp_path}/silver", f"{tmp_path}/dead_letters")
    first = pipeline.run(spark, trips(spark, small), layers, AS_OF)
    wider = cleaning_rules(AS_OF, passengers=(None, 11))
    moved = pipeline.reprocess_dead_letters(spark, layers, AS_OF, wider)
    assert moved["recovered_rows"] > 0
    assert moved["recovered_rows"] + moved["dlq_rows"] == first["dlq_rows"]
    silver, letters = spark.read.parquet(layers.silver), spark.read.parquet(layers.dead_letters)
    assert silver.count() == first["silver_rows"] + moved["recovered_rows"]
    assert letters.count() == moved["dlq_rows"]
    assert silver.where("passenger_count = 11").count() == moved["recovered_rows"]
    again = pipeline.reprocess_dead_letters(spark, layers, AS_OF, wider)
    assert again["recovered_rows"] == 0


def test_a_delivery_replaces_only_itself(spark, small, tmp_path):
    """One stray row of a month that another delivery filled leaves that month alone."""
    layers = layers_at(tmp_path)
    all_trips = trips(spark, small)
    pickup = F.col("tpep_pickup_datetime")
    march = (F.year(pickup) == 1997) & (F.month(pickup) == 3)
    pipeline.run(spark, all_trips.where(march), layers, AS_OF, delivery="1997-03")
    n_march = spark.read.parquet(layers.silver).count()
    april = all_trips.where((F.year(pickup) == 1997) & (F.month(pickup) == 4))
    stray = spark.read.parquet(layers.silver).limit(1).select("trip_id", "payment_type")
    strays = all_trips.join(stray, ["trip_id", "payment_type"], "left_semi")
    for _ in range(2):
        pipeline.run(spark, april.unionByName(strays), layers, AS_OF, delivery="1997-04")
    silver = pipeline.read_layer(spark, layers.silver)
    assert silver.where("delivery = '1997-03'").count() == n_march
    assert silver.where("delivery = '1997-04' AND month = 3").count() == 1
    gold = spark.read.parquet(layers.gold)
    assert gold.agg(F.sum("trips")).first()[0] == silver.count()
    # the delivery comes again without the stray and without any accepted row
    bad = april.withColumn("fare_amount", F.lit(-1.0))
    pipeline.run(spark, bad, layers, AS_OF, delivery="1997-04")
    assert pipeline.read_layer(spark, layers.silver).count() == n_march
    gold = spark.read.parquet(layers.gold)
    assert gold.agg(F.sum("trips")).first()[0] == n_march
    assert {r.month for r in gold.select("month").distinct().collect()} == {3}


@pytest.mark.parametrize("name", ["", "a/b", "a=b", "a b"])
def test_delivery_names(name):
    with pytest.raises(ValueError, match="delivery"):
        pipeline.delivery_path("silver", name)


def test_reprocessing_with_an_empty_dead_letter_layer(spark, small, tmp_path):
    layers = layers_at(tmp_path)
    nothing = {"recovered_rows": 0, "added_rows": 0, "dlq_rows": 0}
    assert pipeline.reprocess_dead_letters(spark, layers, AS_OF, cleaning_rules(AS_OF)) == nothing
    pipeline.run(spark, trips(spark, small).where("false"), layers, AS_OF)
    assert pipeline.reprocess_dead_letters(spark, layers, AS_OF, cleaning_rules(AS_OF)) == nothing


def test_the_same_rows_in_two_deliveries_are_recovered_once(spark, small, tmp_path):
    layers = layers_at(tmp_path)
    for name in ("one", "two"):
        pipeline.run(spark, trips(spark, small).where("passenger_count = 11"), layers, AS_OF, delivery=name)
    letters = pipeline.read_layer(spark, layers.dead_letters)
    assert letters.select("delivery").distinct().count() == 2
    wider = cleaning_rules(AS_OF, passengers=(None, 11))
    moved = pipeline.reprocess_dead_letters(spark, layers, AS_OF, wider)
    assert moved["recovered_rows"] == 2 * moved["added_rows"] > 0
    silver = pipeline.read_layer(spark, layers.silver)
    assert silver.count() == moved["added_rows"]
    assert spark.read.parquet(layers.gold).agg(F.sum("trips")).first()[0] == silver.count()
    assert spark.read.parquet(layers.metrics).where("status = 'reprocessed'").count() == 1


def test_subjects_are_erased_from_both_layers(spark, small, tmp_path):
    layers = layers_at(tmp_path)
    pipeline.run(spark, trips(spark, small), layers, AS_OF, policy=POLICY, salt="pepper of the test")
    whose = trips(spark, small).groupBy("passenger_id").count().orderBy(F.desc("count"), "passenger_id").limit(1)
    subjects = whose.select(F.col("passenger_id").cast("int"))
    known = trips(spark, small).where(F.col("passenger_id") == whose.first()[0]).select(hashed("passenger_id", "pepper of the test")).first()[0]

    def left(path):
        rows = pipeline.read_layer(spark, path)
        return rows.count(), rows.where(F.col("passenger_id_hashed") == known).count()

    before = {path: left(path) for path in (layers.silver, layers.dead_letters)}
    gone = pipeline.erase_from_layers(spark, layers, subjects, "passenger_id", salt="pepper of the test")
    assert gone == {"silver": before[layers.silver][1], "dead_letters": before[layers.dead_letters][1]}
    assert gone["silver"] > 0 and gone["dead_letters"] > 0
    for path, (n, own) in before.items():
        assert left(path) == (n - own, 0)
    assert spark.read.parquet(layers.gold).agg(F.sum("trips")).first()[0] == before[layers.silver][0] - gone["silver"]
    assert sum(pipeline.erase_from_layers(spark, layers, subjects, "passenger_id", salt="pepper of the test").values()) == 0


def test_dead_letters_hold_no_raw_ids_and_can_be_read_again(spark, tmp_path):
    later = "2024-01-01 00:00:00"
    schema = "passenger_id string, trip_id bigint, fare_amount string"
    rows = [(f"P{i}", i, "12" if i % 2 else "12.5") for i in range(6)]
    types = {"trip_id": "bigint", "fare_amount": "int", "passenger_id": "string"}
    bronze = normalize_checked(spark.createDataFrame(rows, schema), types)
    bronze = bronze.withColumns({c: F.col(c) if c in bronze.columns else F.lit(v) for c, v in GOOD.items()})
    layers = layers_at(tmp_path)
    pipeline.run(spark, bronze, layers, later, policy={"passenger_id": PiiClass.HIGH}, salt="pepper", keys=["trip_id"])
    letters = pipeline.read_layer(spark, layers.dead_letters)
    assert letters.count() == 3 and "passenger_id" not in letters.columns
    assert letters.where("_original_record LIKE '%P0%' OR _original_record IS NULL").count() == 0
    assert "pepper" not in letters._jdf.queryExecution().toString()
    moved = pipeline.reprocess_dead_letters(
        spark, layers, later, cleaning_rules(later), policy={"passenger_id": PiiClass.HIGH}, salt="pepper",
        keys=["trip_id"], types={**types, "fare_amount": "double"}, critical=["trip_id"],
    )
    assert moved == {"recovered_rows": 3, "added_rows": 3, "dlq_rows": 0}
    for path in (layers.silver, layers.dead_letters):
        rows = pipeline.read_layer(spark, path)
        assert rows is None or "passenger_id" not in rows.columns


def test_unknown_zones_and_contract_rules_decide(spark, small, tmp_path):
    layers = layers_at(tmp_path)
    zones = spark.read.parquet(f"{small}/nation.parquet").select("n_nationkey")
    part = TRIP_CONTRACT.restricted_to(trips(spark, small).columns)
    plain = pipeline.run(spark, trips(spark, small), layers, AS_OF)
    strict = pipeline.run(spark, trips(spark, small), layers, AS_OF, contract=part, zones=zones)
    assert strict["input_rows"] == plain["input_rows"]
    assert strict["silver_rows"] + strict["dlq_rows"] + strict["duplicate_rows"] == strict["input_rows"]
    assert strict["silver_rows"] < plain["silver_rows"] and strict["warning_rows"] > 0
    silver = spark.read.parquet(layers.silver)
    assert silver.where("PULocationID = 25 OR store_and_fwd_flag NOT IN ('Y', 'N')").count() == 0
    assert not [c for c in silver.columns if c.startswith("_unknown")]


def test_too_many_failures_stop_the_run(spark, small, tmp_path):
    layers = layers_at(tmp_path)
    with pytest.raises(pipeline.FailureRateExceeded, match="32.04 % of 6242 rows"):
        pipeline.run(spark, trips(spark, small), layers, AS_OF, halt_above=10.0)
    assert spark.read.parquet(layers.dead_letters).count() == 2000
    assert not os.path.exists(layers.silver)
    row = spark.read.parquet(layers.metrics).first()
    assert (row.status, row.band, row.alert, row.silver_rows) == ("halted", "halt", True, 4000)


def test_two_runs_of_a_day_keep_each_others_dead_letters(spark, small, tmp_path):
    layers = pipeline.Layers(f"{tmp_path}/silver", f"{tmp_path}/dead_letters")
    pickup = F.year("tpep_pickup_datetime")
    first = trips(spark, small).where(pickup == 1997)
    second = trips(spark, small).where(pickup == 1998)
    n = []
    for bronze, clock in ((first, "01:00:00"), (second, "02:00:00"), (second, "02:00:00")):
        run_ts = f"2001-01-01 {clock}"
        name = "first" if bronze is first else "second"
        n.append(pipeline.run(spark, bronze, layers, run_ts, delivery=name)["dlq_rows"])
    letters = spark.read.parquet(layers.dead_letters)
    assert letters.count() == n[0] + n[1] and n[1] == n[2]
    assert letters.select("day").distinct().count() == 1
    assert {r.run for r in letters.select("run").distinct().collect()} == {
        "20010101_010000",
        "20010101_020000",
    }


def test_first_failure_time_is_kept(spark, small, tmp_path):
    layers = pipeline.Layers(f"{tmp_path}/silver", f"{tmp_path}/dead_letters")
    pipeline.run(spark, trips(spark, small), layers, AS_OF)
    later = "2001-02-01 00:00:00"
    pipeline.reprocess_dead_letters(spark, layers, later, cleaning_rules(AS_OF, passengers=(None, 11)))
    times = spark.read.parquet(layers.dead_letters).select("_failed_at").distinct().collect()
    assert [str(r[0]) for r in times] == [AS_OF]


def test_a_delivery_without_a_contract_column_is_refused(spark, small, tmp_path):
    layers = pipeline.Layers(f"{tmp_path}/silver", f"{tmp_path}/dead_letters")
    with pytest.raises(ValueError, match="RatecodeID"):
        pipeline.run(spark, trips(spark, small), layers, AS_OF, contract=TRIP_CONTRACT)
    assert not os.path.exists(layers.silver)


def test_scratch_is_cleared(spark, small, tmp_path, monkeypatch):
    paths = []
    original = pipeline.scratch_path

    def remember(*args):
        paths.append(original(*args))
        return paths[-1]

    monkeypatch.setattr(pipeline, "scratch_path", remember)
    pipeline.run(spark, trips(spark, small), layers_at(tmp_path), AS_OF)
    assert paths and not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_empty_delivery(spark, small, tmp_path):
    nothing = trips(spark, small).where("false")
    metrics = pipeline.run(spark, nothing, layers_at(tmp_path), AS_OF)
    assert metrics["input_rows"] == 0 and metrics["failure_rate"] == 0.0


def test_retention(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    kept = pipeline.expire_before(events, "ts", "2024-02-10 00:00:00", 30)
    assert 0 < kept.count() < events.count()
    assert kept.agg(F.min(F.to_date("ts"))).first()[0].isoformat() >= "2024-01-11"


def test_letters_of_one_folder_are_not_moved(spark, tmp_path):
    """Rows that belong to one folder lie where they would with its columns taken from the rows."""
    from silverlode.sinks.writers import write_dead_letters

    rows = spark.range(0, 1000, 1, 5).selectExpr("id", "'d' AS delivery", "timestamp_ntz'2001-01-01 00:00:00' AS _failed_at")
    write_dead_letters(rows, f"{tmp_path}/a", by_run=True, first=("delivery",))
    before = pipeline.letter_folders(pipeline.read_layer(spark, f"{tmp_path}/a"))
    folder = pipeline.only_folder(before)
    write_dead_letters(rows, f"{tmp_path}/b", by_run=True, first=("delivery",), folder=folder)
    a, b = (pipeline.read_layer(spark, f"{tmp_path}/{x}") for x in "ab")
    assert a.schema == b.schema and sorted(a.collect()) == sorted(b.collect())
    assert len(b.inputFiles()) == 5  # one for each task that read them
    assert pipeline.only_folder(before | {("e", 2001, 1, 1, "r")}) is None
    assert pipeline.only_folder({("d", None, None, None, None)}) is None and pipeline.only_folder(set()) is None


def test_recovered_rows_meet_the_clean_layer_by_one_shuffle(spark):
    """Its keys are compared as they are; grouping them first moved them twice."""
    from conftest import plan_of

    rows = spark.createDataFrame([(1, 2001, 1), (2, 2001, 1), (None, 2001, 1)], "k int, year int, month int")
    silver = spark.createDataFrame([(1, 2001, 1), (1, 2001, 1), (None, 2001, 1)], "k int, year int, month int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = pipeline._not_yet_there(rows, silver, ["k"], [(2001, 1)])
        assert [r.k for r in fresh.collect()] == [2]
        assert plan_of(fresh, "simple").split("Initial Plan")[-1].count("Exchange hashpartitioning") <= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_one_time_lie_side_by_side(spark, tmp_path):
    """Sorted by time first, routed rows take less room than sorted by amount, and they are the same rows."""
    from silverlode.operators.dedup import dedup

    rows = spark.range(0, 40_000, 1, 2).selectExpr(
        "id", "1 AS VendorID", "timestamp_ntz'2001-01-01 00:00:00' + make_interval(0, 0, 0, int(pmod(hash(id), 500))) AS at",
        "pmod(hash(id, 1), 1000003) / 100.0D AS amount",
    )
    kept = dedup(rows, ["VendorID", "at", "amount"]).coalesce(1)
    assert kept.count() == rows.select("VendorID", "at", "amount").distinct().count()
    kept.write.parquet(f"{tmp_path}/kept")
    times = [r["at"] for r in spark.read.parquet(f"{tmp_path}/kept").collect()]
    changes = sum(a != b for a, b in zip(times, times[1:]))
    assert changes < 500 * spark.sparkContext.defaultParallelism
