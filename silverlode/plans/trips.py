"""The trip table of the test queries, derived from ``lineitem`` and ``orders``.

The given tables hold clean data, so faults are planted by rule: values go missing or wrong for some
part keys, orders with ``key % 50 = 0`` occur twice, and those with ``key % 50 = 1`` occur twice with
another payment type. All rows of both tables take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-01-01 00:00:00"
CUTOFF = "1996-01-01 00:00:00"

TRIP_COLUMNS = (
    "trip_id",
    "passenger_id",
    "driver_id",
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _planted(column: str, faults: dict[int, object]):
    """The column, but another value where the part key is divisible by a number."""
    value = F.col(column) if isinstance(column, str) else column
    chain = None
    for divisor, wrong in faults.items():
        hit = F.col("l_partkey") % divisor == 0
        wrong = F.lit(wrong) if not hasattr(wrong, "alias") else wrong
        chain = F.when(hit, wrong) if chain is None else chain.when(hit, wrong)
    return chain.otherwise(value)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One join, one narrow explode for the copies; nothing is scanned twice."""
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    minutes = F.col("l_quantity").cast("int")
    pickup = F.col("l_shipdate")
    dropoff = F.timestamp_add("MINUTE", minutes, pickup)
    early = F.timestamp_add("MINUTE", -minutes, pickup)
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    payment_shift = (
        F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(0), F.lit(0)))
        .when(F.col("l_orderkey") % 50 == 1, F.array(F.lit(0), F.lit(10)))
        .otherwise(F.array(F.lit(0)))
    )
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"),
        F.col("o_custkey").cast("string").alias("passenger_id"),
        F.col("l_suppkey").cast("string").alias("driver_id"),
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("VendorID"),
        _planted("l_shipdate", {97: None}).alias("tpep_pickup_datetime"),
        _planted(dropoff, {61: None, 53: early}).alias("tpep_dropoff_datetime"),
        F.nullif((minutes % 12).cast("double"), F.lit(7.0)).alias("passenger_count"),
        _planted("l_discount", {71: None, 101: -1.0}).alias("trip_distance"),
        _planted(F.lit("N"), {41: "X", 7: "Y"}).alias("store_and_fwd_flag"),
        (F.col("l_partkey") % 26).cast("int").alias("PULocationID"),
        (F.col("o_custkey") % 25).cast("int").alias("DOLocationID"),
        F.col("l_linenumber").alias("_line"),
        _planted("l_extendedprice", {89: None, 83: -5.0, 79: 0.0}).alias("fare_amount"),
        F.when(tax > 0.075, None)
        .otherwise(_planted("l_tax", {103: -1.0}))
        .alias("tip_amount"),
        _planted(price + tax, {107: -price}).alias("total_amount"),
        F.explode(payment_shift).alias("_shift"),
    ).withColumn("payment_type", F.col("_line") + F.col("_shift")).select(*TRIP_COLUMNS)
