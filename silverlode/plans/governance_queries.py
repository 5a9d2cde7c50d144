"""Queries for privacy, schema control and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.scalars import month_start
from silverlode.operators import monitor, privacy, renames, schema
from silverlode.operators.privacy import PiiClass
from silverlode.operators.route import ERROR_TYPE
from silverlode.plans.inputs import dates_as_text, load, routed_trips, trips
from silverlode.plans.oracle import day, on_routed, on_trips
from silverlode.plans.registry import query
from silverlode.sinks.writers import is_expired

EVENTS_AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2024-02-10 00:00:00"
PERSONAL = ("passenger_id", "driver_id")
NOT_PERSONAL = (
    "trip_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,"
    " store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, tip_amount, total_amount"
)


@query(
    on_trips(
        f"SELECT {NOT_PERSONAL}, sha256(passenger_id) AS passenger_id_hashed,"
        " sha256(driver_id) AS driver_id_hashed FROM trips"
    )
)
def pseudonymize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.pseudonymize(trips(spark, sf_dir), PERSONAL)


@query(
    "SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey_hashed, substr(c_name, 1, 10) AS c_name,"
    " c_nationkey, c_acctbal, c_mktsegment FROM customer"
)
def apply_pii_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = {"c_custkey": PiiClass.HIGH, "c_name": PiiClass.MEDIUM, "c_acctbal": PiiClass.LOW}
    return privacy.apply_policy(load(spark, sf_dir, "customer"), policy, length=10)


K, CODE_LENGTH = 40, 6


def _generalised_sql() -> str:
    """Level by level: groups of K rows are done, the others lose a character."""
    steps = [
        "WITH l6 AS (SELECT lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS code, COUNT(*) AS n FROM lineitem GROUP BY 1),"
        " s6 AS (SELECT code, n, code AS shown, FALSE AS done FROM l6)"
    ]
    for left in range(CODE_LENGTH, 0, -1):
        steps.append(
            f"t{left} AS (SELECT *, sum(n) OVER (PARTITION BY shown, done) AS total FROM s{left}),"
            f" s{left - 1} AS (SELECT code, n, CASE WHEN done OR total >= {K} THEN shown ELSE substr(shown, 1, {left - 1}) END"
            f" AS shown, done OR total >= {K} AS done FROM t{left})"
        )
    return (
        ", ".join(steps)
        + ", g AS (SELECT shown, CAST(SUM(n) AS BIGINT) AS n FROM s0 GROUP BY 1),"
        + " r AS (SELECT coalesce((SELECT n FROM g WHERE shown = ''), 0) AS rest,"
        + " (SELECT shown FROM g WHERE shown <> '' ORDER BY n, shown LIMIT 1) AS least)"
        + f" SELECT CASE WHEN rest > 0 AND rest < {K} AND shown = least THEN '' ELSE shown END AS shown, CAST(SUM(n) AS BIGINT)"
        + f" AS n, SUM(n) >= {K} AS enough FROM g, r GROUP BY 1"
    )


@query(_generalised_sql())
def location_generalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes shortened until each is shared by forty rows, in place of a fixed length."""
    lines = load(spark, sf_dir, "lineitem")
    coded = lines.select(F.lpad(F.col("l_partkey").cast("string"), CODE_LENGTH, "0").alias("code"))
    shown = privacy.generalise(coded, "code", K, CODE_LENGTH)
    n = F.count(F.lit(1))
    return shown.groupBy(F.col("code").alias("shown")).agg(n.alias("n"), (n >= K).alias("enough"))


@query(
    on_trips(
        "SELECT trip_id, payment_type, passenger_id FROM trips WHERE passenger_id IS NULL OR passenger_id"
        " NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)"
    )
)
def erase_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw layer: subjects are matched by id."""
    subjects = load(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    kept = privacy.erase(trips(spark, sf_dir), subjects, "passenger_id", "c_custkey")
    return kept.select("trip_id", "payment_type", "passenger_id")


@query(
    on_trips(
        "SELECT trip_id, payment_type, sha256(passenger_id) AS passenger_id_hashed FROM trips WHERE"
        " passenger_id IS NULL OR passenger_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer"
        " WHERE c_acctbal < 0)"
    )
)
def erase_hashed_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean layer: subjects are matched by hash."""
    subjects = load(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    hashed = privacy.pseudonymize(trips(spark, sf_dir), PERSONAL)
    kept = privacy.erase(hashed, subjects, "passenger_id_hashed", "c_custkey", is_hashed=True)
    return kept.select("trip_id", "payment_type", "passenger_id_hashed")


@query(
    f"""
SELECT 'bronze' AS layer, {day('ts')} AS day, COUNT(*) AS n FROM events
WHERE CAST(ts AS DATE) < DATE '2024-02-10' - 7 GROUP BY 2
UNION ALL
SELECT 'dead_letters', {day('ts')}, COUNT(*) FROM events
WHERE event_type = 'error' AND CAST(ts AS DATE) < DATE '2024-02-10' - 30 GROUP BY 2
"""
)
def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows past their time: raw personal data after 7 days, dead letters after 30."""
    events = load(spark, sf_dir, "events")
    raw = events.where(is_expired("ts", RETENTION_AS_OF, 7)).withColumn("layer", F.lit("bronze"))
    errors = events.where(F.col("event_type") == "error")
    letters = errors.where(is_expired("ts", RETENTION_AS_OF, 30)).withColumn(
        "layer", F.lit("dead_letters")
    )
    counted = [
        df.groupBy("layer", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
        for df in (raw, letters)
    ]
    return dates_as_text(counted[0].unionByName(counted[1]))


# What was agreed about line items at first, and a later version of the agreement.
LINES_V1 = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "int",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_returnflag": "int",
    "l_linestatus": "string",
    "l_comment": "string",
    "l_shipdate": "timestamp_ntz",
}
LINES_NOW = {
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
}


def _drift_sql() -> str:
    def text(value):
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    rows = []
    for c in dict.fromkeys([*LINES_V1, *LINES_NOW]):
        old, new = LINES_V1.get(c), LINES_NOW.get(c)
        change = (
            "added" if old is None else "removed" if new is None else "retyped" if old != new else "same"
        )
        kind = {"added": "non_breaking", "same": "unchanged"}.get(change, "breaking")
        present = "COUNT(NULL)" if new is None else f"COUNT({c})"
        lost = (
            f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS INT) IS NULL)"
            if change == "retyped"
            else "COUNT(NULL)"
        )
        rows.append(
            f"""SELECT '{c}' AS "column", {text(old)} AS old_type, {text(new)} AS new_type,"""
            f" '{change}' AS change, '{kind}' AS change_class, {present} AS n_values,"
            f" {lost} AS n_unreadable FROM lineitem"
        )
    return "SELECT * FROM (" + " UNION ALL ".join(rows) + ")"


@query(_drift_sql())
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered table against the agreed schema, weighted by the values concerned."""
    return schema.schema_drift(load(spark, sf_dir, "lineitem"), LINES_V1)


@query(
    f"""SELECT "column", old_type, new_type, change, n_values FROM ({_drift_sql()}) WHERE change <> 'same'"""
)
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = schema.schema_drift(load(spark, sf_dir, "lineitem"), LINES_V1)
    changed = drift.where(F.col("change") != "same")
    return changed.select("column", "old_type", "new_type", "change", "n_values")


@query(
    f"""SELECT change_class, COUNT(*) AS n_columns, CAST(SUM(n_values) AS BIGINT) AS n_values
FROM ({_drift_sql()}) GROUP BY 1"""
)
def schema_change_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = schema.schema_drift(load(spark, sf_dir, "lineitem"), LINES_V1)
    return drift.groupBy("change_class").agg(
        F.count(F.lit(1)).alias("n_columns"), F.sum("n_values").alias("n_values")
    )


@query(
    """
WITH late AS (SELECT * FROM lineitem WHERE l_orderkey % 2 = 1)
SELECT 'renamed' AS change, 'l_extendedprice' AS old, 'price' AS new, 'breaking' AS change_class, COUNT(l_extendedprice) AS n_values FROM late
UNION ALL SELECT 'renamed', 'l_quantity', 'pieces', 'breaking', COUNT(l_quantity) FROM late
UNION ALL SELECT 'renamed', 'l_shipdate', 'shipped', 'breaking', COUNT(l_shipdate) FROM late
UNION ALL SELECT 'removed', 'l_tax', NULL, 'breaking', CAST(0 AS BIGINT)
UNION ALL SELECT 'added', NULL, 'fee', 'non_breaking', COUNT(l_partkey) FROM late
UNION ALL SELECT 'new code', 'l_returnflag', l_returnflag, 'non_breaking', COUNT(*) FROM late WHERE l_returnflag <> 'N' GROUP BY l_returnflag
"""
)
def schema_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half of the lines against the other, in which three columns have new names and one was replaced.

    Codes that an agreed domain lacks are listed with them.
    """
    lines = load(spark, sf_dir, "lineitem")
    before, late = lines.where("l_orderkey % 2 = 0"), lines.where("l_orderkey % 2 = 1")
    names = {"l_extendedprice": "price", "l_quantity": "pieces", "l_shipdate": "shipped"}
    after = late.withColumn("fee", F.col("l_partkey") * 100.0 + 7.0).drop("l_tax").withColumnsRenamed(names)
    changes = renames.as_frame(spark, renames.find_renames(before, after)).drop("score")
    filled = after.agg(*[F.count(c).alias(c) for c in after.columns]).unpivot([], after.columns, "_column", "_n")
    told = changes.join(filled, F.col("new") == F.col("_column"), "left")
    told = told.select("change", "old", "new", "change_class", F.coalesce("_n", F.lit(0)).alias("n_values"))
    codes = renames.new_codes(after, {"l_returnflag": ("N",)})
    return told.unionAll(
        codes.select(F.lit("new code"), F.col("column"), F.col("code"), F.col("change_class"), F.col("n"))
    )


_MONTHLY = """
SELECT strftime(date_trunc('month', tpep_pickup_datetime), '%Y-%m-%d') AS month, COUNT(*) AS total,
  COUNT(*) FILTER (WHERE error_type IS NOT NULL) AS failed,
  CAST(COUNT(*) FILTER (WHERE error_type IS NOT NULL) AS DOUBLE) * CAST(100 AS DOUBLE)
    / CAST(COUNT(*) AS DOUBLE) AS rate
FROM routed GROUP BY 1
"""


def monthly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = routed_trips(spark, sf_dir).rows
    month = month_start("tpep_pickup_datetime")
    return dates_as_text(monitor.rate_by(rows, month, "month", F.col(ERROR_TYPE).isNotNull()))


@query(
    on_routed(
        "SELECT *, CASE WHEN rate > 10 THEN 'halt' WHEN rate >= 5 THEN 'urgent' WHEN rate >= 1 THEN"
        f" 'warning' ELSE 'normal' END AS band FROM ({_MONTHLY})"
    )
)
def failure_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_rates(spark, sf_dir).drop("alert")


@query(on_routed(f"SELECT month, rate, rate > 1 AS alert FROM ({_MONTHLY})"))
def dlq_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_rates(spark, sf_dir).select("month", "rate", "alert")


@query(
    f"""
WITH runs AS (SELECT {day('ts')} AS day, CAST(hour(ts) AS INT) AS run, COUNT(*) AS total,
  COUNT(*) FILTER (WHERE event_type = 'error') AS failed,
  CAST(date_diff('microsecond', MIN(ts), MAX(ts)) AS DOUBLE) / CAST(60000000 AS DOUBLE) AS runtime_minutes
  FROM events GROUP BY 1, 2),
rated AS (SELECT day, run, total, failed, runtime_minutes,
  CAST(failed AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total AS DOUBLE) AS failure_rate FROM runs)
SELECT *, runtime_minutes > 15 AS slow, failure_rate > 5 AS failing,
  runtime_minutes > 15 OR failure_rate > 5 AS alert FROM rated
"""
)
def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour of events is taken as a run: its span is the runtime, its errors are the failures."""
    events = load(spark, sf_dir, "events")
    span = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).cast("double")
    runs = events.groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("run")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("event_type") == "error").alias("failed"),
        (span / F.lit(60000000.0)).alias("runtime_minutes"),
    )
    rated = monitor.with_rate(runs, "failed", "total").withColumnRenamed("rate", "failure_rate")
    return dates_as_text(monitor.run_alerts(rated))


@query(
    """
SELECT event_type, newest, age_hours, coalesce(age_hours <= 24, FALSE) AS fresh FROM (
  SELECT event_type, MAX(ts) AS newest,
    CAST(date_diff('microsecond', MAX(ts), TIMESTAMP '2024-01-31 00:00:00') AS DOUBLE)
      / CAST(3600000000 AS DOUBLE) AS age_hours
  FROM events GROUP BY event_type)
"""
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.freshness(
        load(spark, sf_dir, "events"), "ts", EVENTS_AS_OF, sla_hours=24, by="event_type"
    )


@query(
    """
SELECT strftime(month, '%Y-%m-%d') AS month, strftime(due, '%Y-%m-%d') AS due,
  strftime(arrived, '%Y-%m-%d') AS arrived, arrived > due AS late FROM (
 SELECT date_trunc('month', o_orderdate) AS month,
  CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH + INTERVAL 4 DAY AS DATE) AS due,
  CAST(MAX(l_shipdate) AS DATE) AS arrived
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
"""
)
def arrival_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of orders with the day their file is due, against the day the last line was shipped."""
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    months = joined.groupBy(month_start("o_orderdate").alias("month")).agg(
        F.to_date(F.max("l_shipdate")).alias("arrived")
    )
    due = months.withColumn("due", monitor.arrival_deadline(F.col("month")))
    return dates_as_text(due.withColumn("late", F.col("arrived") > F.col("due")))


@query(
    f"""
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, json_extract_string(props, '$.k') AS kind,
  COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1, 2
"""
)
def dlq_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events per week and kind of error."""
    errors = load(spark, sf_dir, "events").where(F.col("event_type") == "error")
    kinds = errors.withColumn("kind", F.get_json_object("props", "$.k"))
    return dates_as_text(monitor.weekly_patterns(kinds, "ts", "kind"))
