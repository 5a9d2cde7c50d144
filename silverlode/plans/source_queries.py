"""Queries for readers and writers. Round trips write a whole table and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.contract import ErrorType
from silverlode.operators.clean import ORIGINAL, sample_rows
from silverlode.operators.profile import partition_balance
from silverlode.operators.route import ERROR_TYPE, reread
from silverlode.plans.inputs import load, routed_trips
from silverlode.plans.oracle import on_routed
from silverlode.plans.registry import query, written_once
from silverlode.session import scratch_path
from silverlode.sinks import writers
from silverlode.sources import footers, readers

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LINES = "SELECT *, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month FROM lineitem"


def orders_csv(spark: SparkSession, sf_dir: str) -> str:
    return written_once(
        spark,
        sf_dir,
        "orders-csv",
        lambda path: writers.write_csv(load(spark, sf_dir, "orders"), path),
    )


def lines_by_month(spark: SparkSession, sf_dir: str) -> str:
    return written_once(
        spark,
        sf_dir,
        "lines-by-month",
        lambda path: writers.write_by_month(load(spark, sf_dir, "lineitem"), path, "l_shipdate"),
    )


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_parquet(spark, f"{sf_dir}/orders.parquet")


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "orders").schema
    return readers.read_csv(spark, orders_csv(spark, sf_dir), schema)


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.read_csv(spark, orders_csv(spark, sf_dir))
    keys = {c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}
    # Inference takes a time for one with a zone; the text has none.
    return df.withColumns({**keys, "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")})


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_csv_other_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the file in another order than those of the schema: matched by name."""
    orders = load(spark, sf_dir, "orders")
    turned = orders.select(*reversed(orders.columns))
    path = written_once(spark, sf_dir, "orders-turned", lambda p: writers.write_csv(turned, p))
    return readers.read_csv(spark, path, orders.schema, mode="FAILFAST")


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS note FROM orders"
)
def scan_csv_missing_and_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that the file lacks is lacking in the frame; one that the schema doesn't know is text."""
    orders = load(spark, sf_dir, "orders")
    other = orders.select(F.col("o_orderstatus").alias("note"), *[c for c in orders.columns if c != "o_orderstatus"])
    path = written_once(spark, sf_dir, "orders-other", lambda p: writers.write_csv(other, p))
    return readers.read_csv(spark, path, orders.schema)


def broken_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as text, every tenth with a date that is none."""
    orders = load(spark, sf_dir, "orders")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    bad = F.when(F.col("o_orderkey").cast("bigint") % 10 == 0, "no date").otherwise(F.col("o_orderdate"))
    broken = text.withColumn("o_orderdate", bad)
    return written_once(spark, sf_dir, "orders-broken", lambda p: writers.write_csv(broken, p))


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS o_orderdate, o_orderpriority,
  o_orderkey % 10 = 0 AS is_corrupt
FROM orders
"""
)
def scan_csv_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that don't fit stay, marked, with what could be read of them."""
    schema = load(spark, sf_dir, "orders").schema
    df = readers.read_csv(spark, broken_orders(spark, sf_dir), schema, keep_corrupt=True)
    return df.withColumn("is_corrupt", F.col(readers.CORRUPT).isNotNull()).drop(readers.CORRUPT)


@query(f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderkey % 10 <> 0")
def scan_csv_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "orders").schema
    return readers.read_csv(spark, broken_orders(spark, sf_dir), schema, mode="DROPMALFORMED")


@query(
    "SELECT COUNT(*) FILTER (WHERE o_orderkey % 10 <> 0) AS good, COUNT(*) FILTER (WHERE o_orderkey % 10 = 0) AS bad,"
    " COUNT(*) FILTER (WHERE o_orderkey % 10 = 0) AS bad_with_text FROM orders"
)
def split_corrupt_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "orders").schema
    good, bad = readers.split_corrupt(readers.read_csv(spark, broken_orders(spark, sf_dir), schema, keep_corrupt=True))
    none = F.lit(None).cast("string").alias("text")
    kinds = good.select("o_orderkey", F.lit("good").alias("kind"), none).unionAll(
        bad.select("o_orderkey", F.lit("bad"), readers.CORRUPT)
    )
    keyed = F.col("o_orderkey").isNotNull()
    return kinds.agg(
        F.count_if((F.col("kind") == "good") & keyed).alias("good"),
        F.count_if((F.col("kind") == "bad") & keyed).alias("bad"),
        F.count_if((F.col("kind") == "bad") & F.col("text").contains("no date")).alias("bad_with_text"),
    )


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    path = written_once(spark, sf_dir, "orders-json", lambda p: writers.write_json(orders, p))
    return readers.read_json(spark, path, orders.schema)


@query(
    """
SELECT l_returnflag, meaning, COUNT(*) AS n FROM lineitem
LEFT JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) AS v(flag, meaning)
  ON l_returnflag = flag
GROUP BY l_returnflag, meaning
"""
)
def scan_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-memory rows used as a code list for a whole table."""
    codes = readers.from_rows(
        spark,
        [
            {"flag": "A", "meaning": "accepted"},
            {"flag": "N", "meaning": "none"},
            {"flag": "R", "meaning": "returned"},
        ],
        "flag string, meaning string",
    )
    counts = load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.join(codes, F.col("l_returnflag") == F.col("flag"), "left").drop("flag")


@query("SELECT 'lineitem.parquet' AS source, COUNT(*) AS n FROM lineitem HAVING COUNT(*) > 0")
def source_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the table that their file belongs to, as the scan recorded it."""
    df = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet", lineage=True)
    table = F.regexp_extract(readers.SOURCE_FILE, r"([^/]+\.parquet)(/part-[^/]*)?$", 1)
    return df.groupBy(table.alias("source")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""
)
def scan_merged_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of orders; the earlier one was written before a column existed."""
    orders = load(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    first = written_once(
        spark,
        sf_dir,
        "orders-early",
        lambda p: writers.write_parquet(orders.where(early).drop("o_orderpriority"), p),
    )
    second = written_once(
        spark, sf_dir, "orders-late", lambda p: writers.write_parquet(orders.where(~early), p)
    )
    return readers.read_months(spark, [first, second])


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_months_of_two_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries that disagree on a column's type."""
    orders = load(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    as_double = orders.where(early).withColumn("o_custkey", F.col("o_custkey").cast("double"))

    def write(root: str) -> None:
        writers.write_parquet(as_double, f"{root}/early")
        writers.write_parquet(orders.where(~early), f"{root}/late")

    root = written_once(spark, sf_dir, "orders-two-types", write)
    months = readers.read_months(spark, [f"{root}/early", f"{root}/late"], {"o_custkey": "bigint"})
    return months.select(*ORDER_COLUMNS.split(", "))


@query(
    """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind")
    )
    return readers.union_by_name([customers, suppliers])


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-parquet")
    writers.write_parquet(load(spark, sf_dir, "orders"), path)
    return readers.read_parquet(spark, path)


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-converted")
    source = f"{sf_dir}/orders.parquet"
    writers.parquet_to_csv(spark, source, path)
    return readers.read_csv(spark, path, spark.read.parquet(source).schema)


@query(LINES)
def sink_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines-partitioned")
    writers.write_by_month(load(spark, sf_dir, "lineitem"), path, "l_shipdate")
    return readers.read_parquet(spark, path)


@query(
    """
SELECT * REPLACE (CASE WHEN year(l_shipdate) = 1997 AND month(l_shipdate) = 3 THEN l_quantity + 1
    ELSE l_quantity END AS l_quantity),
  CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month
FROM lineitem
"""
)
def sink_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months are written, then one is published again with other values."""
    path = scratch_path(spark, "lines-republished")
    lines = load(spark, sf_dir, "lineitem")
    writers.write_by_month(lines, path, "l_shipdate")
    month = lines.where((F.year("l_shipdate") == 1997) & (F.month("l_shipdate") == 3))
    again = month.withColumn("l_quantity", F.col("l_quantity") + 1)
    writers.write_by_month(again, path, "l_shipdate", dynamic=True)
    return readers.read_parquet(spark, path)


@query(
    """
SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
  COUNT(*) AS n
FROM events WHERE event_type = 'error' GROUP BY 1, 2, 3
"""
)
def dlq_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events written as dead letters, one folder per day, and counted from the folders."""
    path = scratch_path(spark, "dead-letters")
    errors = load(spark, sf_dir, "events").where(F.col("event_type") == "error")
    writers.write_dead_letters(errors, path, "ts")
    written = readers.read_parquet(spark, path)
    return written.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    on_routed(
        "SELECT * EXCLUDE (copies, had_nulls, error_type, error_message) FROM silver ORDER BY trip_id,"
        " payment_type, VendorID, passenger_id, driver_id, tpep_pickup_datetime, tpep_dropoff_datetime,"
        " passenger_count, trip_distance, store_and_fwd_flag, PULocationID, DOLocationID, fare_amount,"
        " tip_amount, total_amount LIMIT 20"
    ),
    name="sample_rows",
)
def sample_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = routed_trips(spark, sf_dir).silver.drop("processing_timestamp")
    rest = [c for c in silver.columns if c not in ("trip_id", "payment_type", "VendorID")]
    return sample_rows(silver, 20, ["trip_id", "payment_type", "VendorID", *rest])


@query(
    "SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,"
    " COUNT(*) AS n FROM lineitem GROUP BY 1, 2",
    name="partition_balance",
)
def partition_balance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.read_parquet(spark, lines_by_month(spark, sf_dir))
    return partition_balance(df, ["year", "month"])


@query(
    "SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,"
    " COUNT(*) AS n, TRUE AS has_files, TRUE AS has_bytes FROM lineitem GROUP BY 1, 2",
    name="partition_files",
)
def partition_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes depend on how the table was written; what holds for any writing is compared."""
    files = footers.partition_files(spark, lines_by_month(spark, sf_dir), ["year", "month"])
    return files.select(
        "year", "month", "n", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > F.col("n")).alias("has_bytes")
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"
    " WHERE year(l_shipdate) = 1997 AND month(l_shipdate) = 3"
)
def prune_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.read_parquet(spark, lines_by_month(spark, sf_dir))
    wanted = (F.col("year") == 1997) & (F.col("month") == 3)
    return df.where(wanted).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"
    " WHERE year(l_shipdate) = 1997"
)
def prune_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.read_parquet(spark, lines_by_month(spark, sf_dir))
    return df.where(F.col("year") == 1997).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP"
    " '1996-11-15' AND l_shipdate < TIMESTAMP '1997-02-11'"
)
def prune_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.read_parquet(spark, lines_by_month(spark, sf_dir))
    return writers.in_date_range(df, "l_shipdate", "1996-11-15", "1997-02-10").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )


@query("SELECT l_extendedprice FROM lineitem WHERE l_extendedprice > 50000")
def prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.read_parquet(spark, lines_by_month(spark, sf_dir))
    return df.select("l_extendedprice").where(F.col("l_extendedprice") > 50000)


@query(
    """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'abc' END AS unreadable, COUNT(*) AS n,
  CAST(SUM(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_custkey END) AS BIGINT) AS keys
FROM orders GROUP BY 1
"""
)
def months_type_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries disagree on a type, and one of them holds text that is no number at all."""
    orders = load(spark, sf_dir, "orders")
    odd = orders.where("o_orderkey % 2 = 1 OR o_orderkey % 7 = 0")
    text = F.when(F.col("o_orderkey") % 7 == 0, "abc").otherwise(F.col("o_custkey").cast("string"))

    def write(root: str) -> None:
        writers.write_parquet(odd.withColumn("o_custkey", text), f"{root}/odd")
        writers.write_parquet(orders.where("o_orderkey % 2 = 0 AND o_orderkey % 7 <> 0"), f"{root}/even")

    root = written_once(spark, sf_dir, "orders-type-errors", write)
    both = readers.read_months(spark, [f"{root}/odd", f"{root}/even"], {"o_custkey": "bigint"})
    kept = F.get_json_object("_original_record", "$.o_custkey")
    unreadable = F.when(F.col("_type_errors") == "o_custkey", kept)
    return both.groupBy(unreadable.alias("unreadable")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("o_custkey"), F.lit(0)).alias("keys")
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 5 = 0")
def reread_other_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that could not be read are read again by the names of their file's header.

    The file has its columns in another order than the schema, and words where numbers should be.
    """
    orders = load(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("EUR"), F.col("o_totalprice").cast("string")))
    lines = orders.select(
        F.coalesce(price, F.col("o_totalprice").cast("string")).alias("o_totalprice"), "o_custkey", "o_orderkey"
    )
    path = written_once(spark, sf_dir, "orders-other-order", lambda p: writers.write_csv(lines, p))
    schema = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())]
    )
    read = readers.read_csv(spark, path, schema, keep_corrupt=True, keep_named=True)
    letters = read.where(F.col(readers.CORRUPT).isNotNull()).select(
        F.lit(ErrorType.SCHEMA_MISMATCH.value).alias(ERROR_TYPE), ORIGINAL
    )
    again = reread(letters, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "string"}, carry=())
    number = F.regexp_replace("o_totalprice", "^EUR", "").cast("double")
    return again.select("o_orderkey", "o_custkey", number.alias("o_totalprice"))
