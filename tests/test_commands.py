"""The command line on small deliveries in every format."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from silverlode.__main__ import execute, parser
from silverlode.functions.contract import TRIP_CONTRACT

LINES = [
    "1,2023-05-01 10:00:00,2023-05-01 10:20:00,2.0,3.5,1.0,N,10,20,1," + ",".join(["1.5"] * 10),
    "2,2023-06-01 10:00:00,2023-06-01 10:20:00,11.0,3.5,1.0,N,10,20,1," + ",".join(["1.5"] * 10),
    "1,2023-05-01 10:00:00,2023-05-01 10:20:00,2.0,3.5,1.0,N,10,20,1," + ",".join(["1.5"] * 10),
    "one,2023-05-01 10:00:00,broken",
]
RUN_TS = "2024-01-01 00:00:00"


@pytest.fixture
def delivery(tmp_path) -> str:
    path = tmp_path / "trips.csv"
    path.write_text("\n".join([",".join(TRIP_CONTRACT.names), *LINES]) + "\n")
    return str(path)


def command(spark, *words: str) -> str:
    return execute(spark, parser().parse_args(list(words)))


def route(spark, tmp_path, paths, kind, *more):
    words = ["route", *paths, "--format", kind, "--silver", f"{tmp_path}/s", "--dead-letters"]
    return json.loads(command(spark, *words, f"{tmp_path}/d", "--run-ts", RUN_TS, *more))


def test_csv_to_layers_and_back(spark, tmp_path, delivery):
    found = route(spark, tmp_path, [delivery], "csv", "--gold", f"{tmp_path}/g")
    assert (found["input_rows"], found["duplicate_rows"], found["silver_rows"]) == (4, 1, 1)
    assert (found["schema_mismatch_rows"], found["business_rule_rows"]) == (1, 1)
    letters = spark.read.parquet(f"{tmp_path}/d")
    bad = letters.where(F.col("_error_type") == "schema_mismatch").first()
    assert json.loads(bad["_original_record"])["_line"] == LINES[3] and bad["_source_file"].endswith("trips.csv")
    words = ["--silver", f"{tmp_path}/s", "--dead-letters", f"{tmp_path}/d", "--run-ts", RUN_TS]
    moved = json.loads(command(spark, "reprocess", *words, "--max-passengers", "11"))
    assert moved == {"recovered_rows": 1, "added_rows": 1, "dlq_rows": 1}


def test_parquet_and_json_give_the_same_counts(spark, tmp_path, delivery):
    df = spark.read.schema(TRIP_CONTRACT.to_struct()).csv(delivery, header=True).where("VendorID > 0")
    df.write.parquet(f"{tmp_path}/p")
    df.write.json(f"{tmp_path}/j")
    counts = []
    for kind in ("parquet", "json"):
        found = route(spark, tmp_path / kind, [f"{tmp_path}/{kind[0]}"], kind)
        counts.append({k: found[k] for k in ("input_rows", "duplicate_rows", "dlq_rows", "silver_rows")})
    assert counts[0] == counts[1]
    assert counts[0]["input_rows"] == 3


def test_report_and_show(spark, delivery):
    text = command(spark, "report", delivery, "--run-ts", RUN_TS)
    assert "total rows: 4" in text and "duplicate rows: 1" in text
    assert "passenger_count_gt_10: 1" in text
    shown = command(spark, "show", delivery, "--format", "csv", "--rows", "2").splitlines()
    assert shown[0].startswith("VendorID") and shown[-1] == "rows: 4" and len(shown) == 4


def test_convert(spark, tmp_path, small):
    command(spark, "convert", f"{small}/orders.parquet", f"{tmp_path}/csv")
    back = spark.read.csv(f"{tmp_path}/csv", header=True)
    assert back.count() == spark.read.parquet(f"{small}/orders.parquet").count()
