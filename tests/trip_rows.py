"""Single trips for micro fixtures."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-01 00:00:00"
SCHEMA = (
    "trip_id bigint, VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime"
    " timestamp_ntz, passenger_count double, trip_distance double, store_and_fwd_flag string,"
    " PULocationID int, DOLocationID int, payment_type int, fare_amount double, tip_amount double,"
    " total_amount double"
)
GOOD = {
    "trip_id": 1,
    "VendorID": 1,
    "tpep_pickup_datetime": datetime.datetime(2023, 5, 1, 10, 0),
    "tpep_dropoff_datetime": datetime.datetime(2023, 5, 1, 10, 20),
    "passenger_count": 2.0,
    "trip_distance": 3.5,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 12.5,
    "tip_amount": 2.0,
    "total_amount": 16.0,
}


def trip(**changes) -> dict:
    return {**GOOD, **changes}


def frame(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame(list(rows), SCHEMA)
