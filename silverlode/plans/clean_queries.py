"""Queries for projection, casting, filtering and filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions import scalars
from silverlode.functions.contract import FILL_DEFAULTS
from silverlode.functions.predicates import any_null
from silverlode.functions.rules import ends_before_start, negative, zero
from silverlode.operators import clean
from silverlode.operators.schema import describe_schema
from silverlode.operators.validate import violations
from silverlode.plans.inputs import TRIP_TYPES, load, text_trips, trips
from silverlode.plans.oracle import COLUMNS, named, on_trips
from silverlode.plans.registry import query
from silverlode.plans.trips import AS_OF, TRIP_COLUMNS

TYPED = (
    "SELECT * REPLACE (CASE WHEN store_and_fwd_flag = 'X' THEN NULL ELSE payment_type END AS payment_type,"
    " CASE WHEN PULocationID = 25 THEN NULL ELSE passenger_count END AS passenger_count) FROM trips"
)
TYPE_ERRORS = named(
    {"passenger_count": "PULocationID = 25", "payment_type": "store_and_fwd_flag = 'X'"}
)


@query(on_trips(TYPED))
def normalize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalize_types(text_trips(spark, sf_dir), TRIP_TYPES)


@query(
    on_trips(
        f"SELECT trip_id, {TYPE_ERRORS} AS type_errors FROM trips"
        " WHERE PULocationID = 25 OR store_and_fwd_flag = 'X'"
    )
)
def type_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = clean.flag_type_errors(text_trips(spark, sf_dir), TRIP_TYPES)
    return flagged.where(F.col(clean.TYPE_ERRORS) != "").select(
        F.col("trip_id").cast("bigint").alias("trip_id"), F.col(clean.TYPE_ERRORS).alias("type_errors")
    )


@query(
    on_trips(
        f"SELECT {COLUMNS}, TIMESTAMP '{AS_OF}' AS processing_timestamp, 'batch-1' AS batch_id FROM trips"
    )
)
def add_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.add_run_columns(trips(spark, sf_dir), AS_OF, "batch-1")


@query(on_trips("SELECT trip_id, payment_type, fare_amount FROM trips WHERE fare_amount > 10"))
def filter_sql_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = trips(spark, sf_dir).filter("fare_amount > 10")
    return kept.select("trip_id", "payment_type", "fare_amount")


@query(on_trips(f"SELECT {COLUMNS} FROM trips WHERE trip_distance = 0"))
def examples_zero_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations(trips(spark, sf_dir), zero("trip_distance"))


@query(on_trips(f"SELECT {COLUMNS} FROM trips WHERE fare_amount < 0"))
def examples_negative_fare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations(trips(spark, sf_dir), negative("fare_amount"))


@query(on_trips(f"SELECT {COLUMNS} FROM trips WHERE tpep_dropoff_datetime < tpep_pickup_datetime"))
def examples_dropoff_before_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = ends_before_start("tpep_pickup_datetime", "tpep_dropoff_datetime", "order")
    return violations(trips(spark, sf_dir), rule)


@query(
    on_trips(
        "SELECT * REPLACE (coalesce(passenger_count, 1.0) AS passenger_count,"
        " coalesce(tip_amount, 0.0) AS tip_amount) FROM trips"
    )
)
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.fill_defaults(trips(spark, sf_dir), FILL_DEFAULTS)


@query(
    on_trips(
        """
SELECT 'passenger_count' AS "column", COUNT(*) FILTER (WHERE passenger_count IS NULL) AS filled FROM trips
UNION ALL SELECT 'tip_amount', COUNT(*) FILTER (WHERE tip_amount IS NULL) FROM trips
"""
    )
)
def fill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.fill_counts(trips(spark, sf_dir), FILL_DEFAULTS)


@query(
    on_trips(
        "SELECT trip_id, payment_type, passenger_count FROM trips WHERE passenger_count BETWEEN 1 AND 6"
    )
)
def passenger_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = trips(spark, sf_dir).where(F.col("passenger_count").between(1, 6))
    return kept.select("trip_id", "payment_type", "passenger_count")


@query(
    "SELECT l_orderkey, l_linenumber, l_shipdate, CAST(year(l_shipdate) AS INT) AS year,"
    " CAST(month(l_shipdate) AS INT) AS month FROM lineitem"
)
def derive_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return df.withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})


SECONDS = (
    "CAST((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) // 1000000 AS DOUBLE)"
)


@query(
    on_trips(
        f"""
SELECT trip_id, payment_type,
  {SECONDS} / CAST(60 AS DOUBLE) AS duration_minutes,
  CASE WHEN {SECONDS} <> 0 THEN trip_distance * CAST(3600 AS DOUBLE) / {SECONDS} END AS speed_mph,
  CASE WHEN fare_amount <> 0 THEN tip_amount / fare_amount END AS tip_rate
FROM trips
"""
    )
)
def derived_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.trip_metrics(trips(spark, sf_dir)).select(
        "trip_id", "payment_type", "duration_minutes", "speed_mph", "tip_rate"
    )


@query(
    on_trips(
        "SELECT trip_id, passenger_id, driver_id, VendorID AS vendor_id, tpep_pickup_datetime,"
        " tpep_dropoff_datetime, passenger_count, trip_distance, store_and_fwd_flag,"
        " PULocationID AS pu_location_id, DOLocationID AS do_location_id, payment_type, fare_amount,"
        " tip_amount, total_amount FROM trips"
    )
)
def snake_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.snake_case(trips(spark, sf_dir))


@query(
    on_trips(
        f"""
SELECT trip_id, payment_type,
  ({" OR ".join(f"{c} IS NULL" for c in TRIP_COLUMNS)}) AS _has_nulls,
  {named({c: f"{c} IS NULL" for c in TRIP_COLUMNS})} AS _null_columns
FROM trips
"""
    )
)
def flag_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = clean.flag_nulls(trips(spark, sf_dir), TRIP_COLUMNS)
    return flagged.select("trip_id", "payment_type", "_has_nulls", "_null_columns")


@query(
    on_trips(
        f"SELECT COUNT(*) AS n FROM trips WHERE {' OR '.join(f'{c} IS NULL' for c in TRIP_COLUMNS)}"
    )
)
def rows_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).agg(F.count_if(any_null(TRIP_COLUMNS)).alias("n"))


@query(
    on_trips(
        """
SELECT trip_id, payment_type,
  (tpep_pickup_datetime AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS tpep_pickup_datetime,
  (tpep_dropoff_datetime AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS tpep_dropoff_datetime
FROM trips
"""
    )
)
def to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
    df = clean.utc_columns(trips(spark, sf_dir), columns, "America/New_York")
    return df.select("trip_id", "payment_type", *columns)


@query(
    on_trips(
        """
SELECT trip_id, payment_type, CAST(CAST(fare_amount AS DECIMAL(18,2)) AS VARCHAR) AS fare_amount,
  CAST(CAST(tip_amount AS DECIMAL(18,2)) AS VARCHAR) AS tip_amount,
  CAST(CAST(total_amount AS DECIMAL(18,2)) AS VARCHAR) AS total_amount
FROM trips
"""
    )
)
def money_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["fare_amount", "tip_amount", "total_amount"]
    df = clean.money_columns(trips(spark, sf_dir), columns)
    return df.select(
        "trip_id", "payment_type", *[F.col(c).cast("string").alias(c) for c in columns]
    )


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS ordinal, '{c}' AS name, '{t}' AS type, COUNT({c}) AS n_values FROM lineitem"
        for i, (c, t) in enumerate(
            {
                "l_orderkey": "bigint",
                "l_partkey": "bigint",
                "l_suppkey": "bigint",
                "l_linenumber": "int",
                "l_quantity": "double",
                "l_extendedprice": "double",
                "l_discount": "double",
                "l_tax": "double",
                "l_returnflag": "string",
                "l_linestatus": "string",
                "l_shipdate": "timestamp_ntz",
            }.items()
        )
    )
    + ")",
    name="describe_schema",
)
def describe_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_schema(load(spark, sf_dir, "lineitem"))


@query(
    """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS as_int,
  CAST(l_partkey AS DOUBLE) AS as_double, l_tax IS NULL AS is_null, l_tax IS NOT NULL AS is_not_null,
  l_quantity < 10 AS lt, l_quantity <= 10 AS le, l_quantity > 10 AS gt, l_quantity = 10 AS eq,
  (l_quantity < 10 AND l_tax > 0.05) OR NOT (l_discount < 0.05) AS logic,
  CAST(1 AS INT) AS one, TIMESTAMP '2001-01-01 00:00:00' AS run_ts,
  TIMESTAMP '2009-01-01 00:00:00' AS cutoff,
  CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS label,
  CAST(100 - l_linenumber * 5 AS INT) AS arithmetic,
  CAST(year(l_shipdate) AS INT) AS y, CAST(month(l_shipdate) AS INT) AS m,
  sha256(CAST(l_suppkey AS VARCHAR)) AS hash, substr(l_linestatus || l_returnflag, 1, 1) AS coarse
FROM lineitem
"""
)
def scalar_sampler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scalar function of the library on one projection."""
    quantity = F.col("l_quantity")
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        quantity.try_cast("int").alias("as_int"),
        F.col("l_partkey").cast("double").alias("as_double"),
        F.col("l_tax").isNull().alias("is_null"),
        F.col("l_tax").isNotNull().alias("is_not_null"),
        (quantity < 10).alias("lt"),
        (quantity <= 10).alias("le"),
        (quantity > 10).alias("gt"),
        (quantity == 10).alias("eq"),
        (((quantity < 10) & (F.col("l_tax") > 0.05)) | ~(F.col("l_discount") < 0.05)).alias("logic"),
        F.lit(1).alias("one"),
        scalars.ntz(AS_OF).alias("run_ts"),
        scalars.parse_timestamp(F.lit("2009-01-01 00:00:00")).alias("cutoff"),
        F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept").alias("label"),
        (F.lit(100) - F.col("l_linenumber") * 5).alias("arithmetic"),
        F.year("l_shipdate").alias("y"),
        F.month("l_shipdate").alias("m"),
        scalars.hashed("l_suppkey").alias("hash"),
        F.substring(F.concat("l_linestatus", "l_returnflag"), 1, 1).alias("coarse"),
    )
