"""Queries for aggregates, joins and daily windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.operators import gold, history, monitor, relations
from silverlode.operators.privacy import pseudonymize
from silverlode.plans.inputs import dates_as_text, load, routed_trips, trips
from silverlode.plans.layer_queries import whole_layers
from silverlode.plans.oracle import COLUMNS, day, money_sum, on_routed, on_trips
from silverlode.plans.registry import query, written_once
from silverlode.sinks.writers import write_parquet

PURCHASES = "(SELECT * FROM events WHERE event_type = 'purchase')"
DAILY = f"SELECT {day('ts')} AS day, COUNT(*) AS n"
REVENUE = f"{DAILY}, {money_sum('value')} AS revenue FROM {PURCHASES} GROUP BY 1"
FAILURES = f"{DAILY}, COUNT(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1"


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").where(F.col("event_type") == "purchase")


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return gold.daily_failure(events, "ts", F.col("event_type") == "error")


@query(REVENUE)
def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(gold.daily_revenue(purchases(spark, sf_dir), "ts", "value"))


@query(f"{DAILY} FROM events GROUP BY 1")
def daily_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(gold.daily_count(load(spark, sf_dir, "events"), "ts"))


@query(
    f"""
WITH d AS (SELECT {day('ts')} AS day, {money_sum('value')} / CAST(COUNT(value) AS DOUBLE) AS mean_value
  FROM events WHERE event_type = 'view' GROUP BY 1),
p AS (SELECT *, lag(mean_value) OVER (ORDER BY day) AS previous FROM d)
SELECT day, mean_value, previous,
  coalesce(abs(mean_value - previous) > previous * CAST(0.5 AS DOUBLE), FALSE) AS shifted FROM p
"""
)
def distance_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = load(spark, sf_dir, "events").where(F.col("event_type") == "view")
    return dates_as_text(gold.daily_mean_shift(views, "ts", "value"))


@query(
    f"""
WITH d AS ({REVENUE}),
t AS (SELECT *, CAST(SUM(CAST(revenue AS DECIMAL(38,10))) OVER w AS DOUBLE)
    / CAST(COUNT(revenue) OVER w AS DOUBLE) AS raw_mean, COUNT(revenue) OVER w AS days FROM d
  WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
m AS (SELECT day, n, revenue, CASE WHEN days > 0 THEN raw_mean END AS trailing_mean FROM t)
SELECT *, coalesce(revenue < trailing_mean * CAST(0.6 AS DOUBLE), FALSE) AS alert FROM m
"""
)
def revenue_vs_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = gold.daily_revenue(purchases(spark, sf_dir), "ts", "value")
    return dates_as_text(gold.versus_trailing(revenue, "revenue"))


@query(
    f"""
WITH d AS (SELECT {day('l_shipdate')} AS day, dayofweek(MIN(l_shipdate)) AS weekday, COUNT(*) AS n,
    {money_sum('l_extendedprice')} AS revenue FROM lineitem GROUP BY 1),
p AS (SELECT *, coalesce(list(revenue) OVER (PARTITION BY weekday ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), [])
    AS past FROM d),
b AS (SELECT *, len(past) AS k, list_sort(past) AS s FROM p),
m AS (SELECT *, CASE WHEN k > 0 THEN (s[(k + 1) // 2] + s[k // 2 + 1]) / CAST(2 AS DOUBLE) END AS baseline FROM b),
a AS (SELECT *, list_sort(list_transform(past, lambda x: abs(x - baseline))) AS t FROM m),
v AS (SELECT *, CASE WHEN k > 0 THEN (t[(k + 1) // 2] + t[k // 2 + 1]) / CAST(2 AS DOUBLE) END * CAST(1.4826 AS DOUBLE)
    AS deviation FROM a)
SELECT day, n, revenue, baseline, deviation,
  coalesce(abs(revenue - baseline) > deviation * CAST(3 AS DOUBLE) AND k >= 4, FALSE) AS alert FROM v
"""
)
def seasonal_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue against the medians of its weekday."""
    revenue = gold.daily_revenue(load(spark, sf_dir, "lineitem"), "l_shipdate", "l_extendedprice")
    return dates_as_text(gold.versus_weekday(revenue, "revenue"))


@query(
    """
WITH z AS (SELECT CAST(l_partkey % 26 AS INT) AS zone, year(l_shipdate) AS y, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
s AS (SELECT zone, 'grade ' || (n % 3) AS grade, y FROM z WHERE n % 7 <> 0),
c AS (SELECT y, lead(y) OVER (ORDER BY y) AS until FROM (SELECT DISTINCT y FROM s)),
f AS (SELECT *, CASE WHEN lag(grade) OVER w = grade AND lag(until) OVER w = y THEN 0 ELSE 1 END AS starts
    FROM s JOIN c USING (y) WINDOW w AS (PARTITION BY zone ORDER BY y)),
r AS (SELECT *, sum(starts) OVER (PARTITION BY zone ORDER BY y) AS run FROM f)
SELECT zone, grade, min(y) || '-01-01' AS valid_from,
  CASE WHEN NOT bool_or(until IS NULL) THEN max(until) || '-01-01' END AS valid_to FROM r GROUP BY zone, grade, run
"""
)
def dim_zone_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which grade a zone had from when to when, from yearly deliveries; the grade comes from the zone's lines."""
    lines = load(spark, sf_dir, "lineitem")
    yearly = lines.groupBy((F.col("l_partkey") % 26).cast("int").alias("zone"), F.year("l_shipdate").alias("_year")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    shown = yearly.where("_n % 7 <> 0").select(
        "zone",
        F.concat(F.lit("grade "), F.col("_n") % 3).alias("grade"),
        F.make_date("_year", F.lit(1), F.lit(1)).alias("day"),
    )
    return dates_as_text(history.validity(shown, "zone", ["grade"], "day"))


@query(
    f"""
WITH d AS ({REVENUE}), p AS (SELECT *, lag(revenue) OVER (ORDER BY day) AS previous FROM d)
SELECT *, revenue - previous AS delta FROM p
"""
)
def day_over_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = gold.daily_revenue(purchases(spark, sf_dir), "ts", "value")
    return dates_as_text(gold.day_over_day(revenue, "revenue"))


@query(
    f"""
WITH d AS ({FAILURES}),
r AS (SELECT *, CAST(failed AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(n AS DOUBLE) AS rate,
  CASE WHEN COUNT(*) OVER w > 0 THEN CAST(SUM(failed) OVER w AS DOUBLE) * CAST(100 AS DOUBLE)
    / CAST(SUM(n) OVER w AS DOUBLE) END AS baseline_rate FROM d
  WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT *, coalesce(rate > baseline_rate * 2, FALSE) AS alert FROM r
"""
)
def dlq_rate_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(gold.rate_versus_baseline(failures(spark, sf_dir)))


@query(
    f"""
WITH d AS ({FAILURES})
SELECT *, CAST(SUM(n) OVER w AS BIGINT) AS rows_in_window,
  CAST(SUM(failed) OVER w AS BIGINT) AS failed_in_window,
  CAST(SUM(failed) OVER w AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(SUM(n) OVER w AS DOUBLE) AS trend_rate
FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
"""
)
def quality_trend_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(gold.rate_trend(failures(spark, sf_dir)))


GOLD_SQL = (
    f"SELECT {day('tpep_pickup_datetime')} AS day, PULocationID AS zone, COUNT(*) AS trips,"
    f" {money_sum('total_amount')} AS revenue FROM silver GROUP BY 1, 2"
)


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = routed_trips(spark, sf_dir).silver
    return gold.daily_revenue_by_zone(
        silver, "tpep_pickup_datetime", "PULocationID", "total_amount"
    )


@query(on_routed(GOLD_SQL))
def gold_daily_revenue_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(gold_table(spark, sf_dir))


@query(
    on_routed(
        f"SELECT (SELECT COUNT(*) FROM silver) AS detail_rows, CAST(SUM(trips) AS BIGINT) AS rollup_rows,"
        f" (SELECT COUNT(*) FROM silver) = SUM(trips) AS passed FROM ({GOLD_SQL})"
    )
)
def gold_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written clean layer against the written aggregates."""
    layers = whole_layers(spark, sf_dir)
    return relations.reconcile(spark.read.parquet(layers.silver), spark.read.parquet(layers.gold), "trips")


@query(on_routed(f"SELECT COUNT(*) AS n, COUNT(*) > 0 AS passed FROM ({GOLD_SQL})"))
def gold_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.not_empty(gold_table(spark, sf_dir))


@query(on_routed(f"SELECT day, zone, revenue FROM ({GOLD_SQL})"))
def gold_view_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = gold.department_view(
        gold_table(spark, sf_dir), "gold_finance", ["day", "zone", "revenue"]
    )
    return dates_as_text(view)


@query(on_routed(f"SELECT day, zone, trips FROM ({GOLD_SQL})"))
def gold_view_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = gold.department_view(
        gold_table(spark, sf_dir), "gold_operations", ["day", "zone", "trips"]
    )
    return dates_as_text(view)


@query(
    on_routed("SELECT sha256(passenger_id) AS passenger_id_hashed, COUNT(*) AS trips FROM silver GROUP BY 1")
)
def trips_per_passenger_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = pseudonymize(routed_trips(spark, sf_dir).silver, ["passenger_id", "driver_id"])
    return gold.trips_per_subject(hashed, "passenger_id_hashed")


@query(
    on_trips(
        "SELECT PULocationID, COUNT(*) AS n FROM trips WHERE PULocationID IS NOT NULL AND PULocationID"
        " NOT IN (SELECT n_nationkey FROM nation) GROUP BY 1"
    )
)
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = load(spark, sf_dir, "nation")
    return relations.orphan_keys(trips(spark, sf_dir), "PULocationID", zones, "n_nationkey")


@query(
    on_trips(
        "SELECT CASE WHEN PULocationID IS NULL THEN 'null_key' WHEN n_nationkey IS NULL THEN 'orphan'"
        " ELSE 'matched' END AS state, COUNT(*) AS n FROM trips LEFT JOIN nation ON PULocationID ="
        " n_nationkey GROUP BY 1"
    )
)
def fk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = load(spark, sf_dir, "nation")
    return relations.reference_report(trips(spark, sf_dir), "PULocationID", zones, "n_nationkey")


@query(
    on_trips(
        f"SELECT {COLUMNS}, n_name AS pickup_zone, n_regionkey AS pickup_region FROM trips"
        " LEFT JOIN nation ON PULocationID = n_nationkey"
    )
)
def enrich_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.enrich(
        trips(spark, sf_dir),
        "PULocationID",
        load(spark, sf_dir, "nation"),
        "n_nationkey",
        {"pickup_zone": "n_name", "pickup_region": "n_regionkey"},
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = {"first_pickup": F.min("tpep_pickup_datetime")}
    return relations.build_dimension(trips(spark, sf_dir), "VendorID", "vendor", attributes)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = relations.enrich(
        load(spark, sf_dir, "nation"),
        "n_regionkey",
        load(spark, sf_dir, "region"),
        "r_regionkey",
        {"region": "r_name"},
    )
    attributes = {"zone_name": F.min("n_name"), "region": F.min("region")}
    return relations.build_dimension(named, "n_nationkey", "zone", attributes)


@query(
    on_trips(
        "SELECT sha256(CAST(VendorID AS VARCHAR)) AS vendor_key, VendorID AS vendor_id,"
        " MIN(tpep_pickup_datetime) AS first_pickup FROM trips WHERE VendorID IS NOT NULL GROUP BY VendorID"
    )
)
def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendors(spark, sf_dir)


@query(
    "SELECT sha256(CAST(n_nationkey AS VARCHAR)) AS zone_key, n_nationkey AS zone_id, MIN(n_name) AS"
    " zone_name, MIN(r_name) AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"
    " WHERE n_nationkey IS NOT NULL GROUP BY n_nationkey"
)
def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones(spark, sf_dir)


@query(
    on_routed(
        """
SELECT sha256(CAST(VendorID AS VARCHAR)) AS vendor_key,
  sha256(CAST(p.n_nationkey AS VARCHAR)) AS pickup_zone_key,
  sha256(CAST(d.n_nationkey AS VARCHAR)) AS dropoff_zone_key,
  trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, fare_amount, tip_amount, total_amount
FROM silver LEFT JOIN nation p ON PULocationID = p.n_nationkey
LEFT JOIN nation d ON DOLocationID = d.n_nationkey
"""
    )
)
def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions are written before the facts are built, as in any star schema."""

    def written(name: str, dim: DataFrame) -> DataFrame:
        return spark.read.parquet(written_once(spark, sf_dir, name, lambda path: write_parquet(dim, path)))

    zone = written("dim-zone", zones(spark, sf_dir))
    vendor = written("dim-vendor", vendors(spark, sf_dir))
    return relations.build_fact(
        routed_trips(spark, sf_dir).silver,
        {
            "VendorID": ("vendor", vendor),
            "PULocationID": ("pickup_zone", zone),
            "DOLocationID": ("dropoff_zone", zone),
        },
        [
            "trip_id",
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "trip_distance",
            "fare_amount",
            "tip_amount",
            "total_amount",
        ],
    )


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN"
    " (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)"
)
def missing_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = load(spark, sf_dir, "lineitem")
    return relations.absent_members(orders, "o_orderkey", lines, "l_orderkey")


@query(
    "SELECT COUNT(*) AS expected, COUNT(*) FILTER (WHERE present) AS present,"
    " COUNT(*) FILTER (WHERE NOT present) AS absent FROM (SELECT o_orderkey IN (SELECT l_orderkey FROM"
    " lineitem) AS present FROM orders)"
)
def dimension_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    return relations.completeness(orders, "o_orderkey", lines, "l_orderkey")
