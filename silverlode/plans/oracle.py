"""SQL building blocks for the oracles: the trip table and the routing, written independently."""

TRIPS = """
WITH base AS (SELECT
 l_orderkey AS k, l_orderkey*10 + l_linenumber AS trip_id,
 CAST(o_custkey AS VARCHAR) AS passenger_id,
 CAST(l_suppkey AS VARCHAR) AS driver_id,
 CAST(l_suppkey % 2 + 1 AS INT) AS VendorID,
 CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_shipdate END AS tpep_pickup_datetime,
 CASE WHEN l_partkey % 61 = 0 THEN NULL
      WHEN l_partkey % 53 = 0 THEN l_shipdate - to_minutes(CAST(l_quantity AS BIGINT))
      ELSE l_shipdate + to_minutes(CAST(l_quantity AS BIGINT)) END AS tpep_dropoff_datetime,
 NULLIF(CAST(CAST(l_quantity AS INT) % 12 AS DOUBLE), CAST(7 AS DOUBLE)) AS passenger_count,
 CASE WHEN l_partkey % 71 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN CAST(-1 AS DOUBLE)
      ELSE l_discount END AS trip_distance,
 CASE WHEN l_partkey % 41 = 0 THEN 'X' WHEN l_partkey % 7 = 0 THEN 'Y' ELSE 'N' END
   AS store_and_fwd_flag,
 CAST(l_partkey % 26 AS INT) AS PULocationID,
 CAST(o_custkey % 25 AS INT) AS DOLocationID,
 CAST(l_linenumber AS INT) AS payment_type,
 CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN CAST(-5 AS DOUBLE)
      WHEN l_partkey % 79 = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS fare_amount,
 CASE WHEN l_tax > 0.075 THEN NULL WHEN l_partkey % 103 = 0 THEN CAST(-1 AS DOUBLE)
      ELSE l_tax END AS tip_amount,
 CASE WHEN l_partkey % 107 = 0 THEN -l_extendedprice ELSE l_extendedprice + l_tax END
   AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
allrows AS (SELECT * FROM base
 UNION ALL SELECT * FROM base WHERE k % 50 = 0
 UNION ALL SELECT * REPLACE (payment_type + 10 AS payment_type) FROM base WHERE k % 50 = 1),
trips AS (SELECT trip_id, passenger_id, driver_id, VendorID, tpep_pickup_datetime,
 tpep_dropoff_datetime, passenger_count, trip_distance, store_and_fwd_flag, PULocationID,
 DOLocationID, payment_type, fare_amount, tip_amount, total_amount FROM allrows)
"""

KEYS = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, total_amount"
)
REST = (
    "trip_id NULLS FIRST, passenger_id NULLS FIRST, driver_id NULLS FIRST, "
    "passenger_count NULLS FIRST, trip_distance NULLS FIRST, store_and_fwd_flag NULLS FIRST, "
    "payment_type NULLS FIRST, fare_amount NULLS FIRST, tip_amount NULLS FIRST"
)
COLUMNS = (
    "trip_id, passenger_id, driver_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, "
    "passenger_count, trip_distance, store_and_fwd_flag, PULocationID, DOLocationID, payment_type, "
    "fare_amount, tip_amount, total_amount"
)
AS_OF = "TIMESTAMP '2001-01-01 00:00:00'"
CUTOFF = "TIMESTAMP '1996-01-01 00:00:00'"
CRITICAL = (
    "tpep_pickup_datetime",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
)


def dedup_sql(source: str = "trips", keys: str = KEYS, rest: str = REST) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, count(*) OVER (PARTITION BY {keys}) AS copies, "
        f"row_number() OVER (PARTITION BY {keys} ORDER BY {rest}) AS rn FROM {source}) WHERE rn = 1"
    )


def rules_sql(max_passengers: int = 10) -> dict[str, str]:
    """Rule name -> condition under which a row breaks it."""
    return {
        "fare_amount_negative": "fare_amount < 0",
        "trip_distance_negative": "trip_distance < 0",
        "total_amount_negative": "total_amount < 0",
        "tip_amount_negative": "tip_amount < 0",
        "passenger_count_low": "passenger_count <= 0",
        f"passenger_count_gt_{max_passengers}": f"passenger_count > {max_passengers}",
        "pickup_in_future": f"tpep_pickup_datetime > {AS_OF}",
        "dropoff_in_future": f"tpep_dropoff_datetime > {AS_OF}",
        "dropoff_before_pickup": "coalesce(tpep_dropoff_datetime < tpep_pickup_datetime, FALSE)",
    }


def named(flags: dict[str, str]) -> str:
    """Names of the flags that hold, comma separated."""
    return "concat_ws(', ', " + ", ".join(
        f"CASE WHEN {cond} THEN '{name}' END" for name, cond in flags.items()
    ) + ")"


def judge_sql(source: str, max_passengers: int = 10, more: dict[str, str] | None = None) -> str:
    """The verdict of each row of a table expression, with its message; ``more`` are further rules."""
    rules = rules_sql(max_passengers) | (more or {})
    missing = " OR ".join(f"{c} IS NULL" for c in CRITICAL)
    violated = " OR ".join(f"coalesce({c}, FALSE)" for c in rules.values())
    undecided = " OR ".join(f"({c}) IS NULL" for c in rules.values())
    filled = (
        f"SELECT * REPLACE (CASE WHEN missing THEN passenger_count ELSE coalesce(passenger_count, 1.0) END"
        f" AS passenger_count, CASE WHEN missing THEN tip_amount ELSE coalesce(tip_amount, 0.0) END AS"
        f" tip_amount) FROM (SELECT *, ({missing}) AS missing, (passenger_count IS NULL OR tip_amount"
        f" IS NULL) AS had_nulls FROM ({source}))"
    )
    return (
        f"SELECT * EXCLUDE (missing), "
        f"CASE WHEN missing THEN 'missing_critical_column' WHEN {violated} THEN 'business_rule_failed'"
        f" WHEN {undecided} THEN 'rule_indeterminate' END AS error_type, "
        f"CASE WHEN missing THEN {named({c: c + ' IS NULL' for c in CRITICAL})} WHEN {violated} THEN"
        f" {named({n: f'coalesce({c}, FALSE)' for n, c in rules.items()})} WHEN {undecided} THEN"
        f" {named({n: f'({c}) IS NULL' for n, c in rules.items()})} END AS error_message"
        f" FROM ({filled})"
    )


SCORE = (
    "CAST(100 - CASE WHEN had_nulls THEN 10 ELSE 0 END - CASE WHEN trip_distance = 0 THEN 5 ELSE 0 END"
    " - CASE WHEN fare_amount = 0 THEN 5 ELSE 0 END AS INT)"
)


def on_trips(select: str) -> str:
    return TRIPS + select


def on_survivors(select: str) -> str:
    return TRIPS + f", survivors AS ({dedup_sql()}) " + select


def on_routed(select: str) -> str:
    """``routed``: survivors with verdict; ``silver``: accepted rows with their score."""
    return (
        TRIPS
        + f", routed AS ({judge_sql(dedup_sql())}), "
        + f"silver AS (SELECT *, {SCORE} AS data_quality_score FROM routed WHERE error_type IS NULL) "
        + select
    )


def money_sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(38,10))) AS DOUBLE)"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"
