"""Queries for validation rules, routing and the data contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions import rules
from silverlode.functions.contract import (
    CRITICAL_COLUMNS,
    FILL_DEFAULTS,
    TRIP_CONTRACT,
    ErrorType,
)
from silverlode.functions.predicates import any_null
from silverlode.functions.rules import cleaning_rules
from silverlode.operators import route as routing
from silverlode.operators import validate
from silverlode.operators.clean import normalize_checked
from silverlode.operators.layers import layered_report
from silverlode.operators.relations import orphan_rows
from silverlode.plans import pipeline
from silverlode.plans.inputs import TRIP_TYPES, load, routed_trips, text_trips, trips
from silverlode.plans.layer_queries import layers_of
from silverlode.plans.oracle import AS_OF as AS_OF_SQL
from silverlode.plans.oracle import (
    COLUMNS,
    KEYS,
    REST,
    TRIPS,
    dedup_sql,
    judge_sql,
    named,
    on_routed,
    on_trips,
    rules_sql,
)
from silverlode.plans.oracle import CUTOFF as CUTOFF_SQL
from silverlode.plans.pipeline import Layers
from silverlode.plans.registry import query
from silverlode.plans.trips import AS_OF, CUTOFF, TRIP_COLUMNS

CONTRACT = TRIP_CONTRACT.restricted_to(list(TRIP_COLUMNS))


def _rule_query(name: str, make_rules, condition: str, columns: tuple[str, ...]) -> None:
    """Register the rows that break any of some rules."""
    shown = ["trip_id", "payment_type", *columns]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = [r.condition for r in make_rules()]
        wrong = found[0]
        for other in found[1:]:
            wrong = wrong | other
        return trips(spark, sf_dir).where(wrong).select(*shown)

    query(on_trips(f"SELECT {', '.join(shown)} FROM trips WHERE {condition}"), name=name)(run)


_rule_query(
    "rule_fare_negative", lambda: [rules.negative("fare_amount")], "fare_amount < 0", ("fare_amount",)
)
_rule_query(
    "rule_distance_negative",
    lambda: [rules.negative("trip_distance")],
    "trip_distance < 0",
    ("trip_distance",),
)
_rule_query(
    "rule_total_negative",
    lambda: [rules.negative("total_amount")],
    "total_amount < 0",
    ("total_amount",),
)
_rule_query(
    "rule_tip_negative", lambda: [rules.negative("tip_amount")], "tip_amount < 0", ("tip_amount",)
)
_rule_query(
    "rule_passenger_low",
    lambda: [rules.not_positive("passenger_count")],
    "passenger_count <= 0",
    ("passenger_count",),
)
_rule_query(
    "rule_passenger_high",
    lambda: [rules.above("passenger_count", 10)],
    "passenger_count > 10",
    ("passenger_count",),
)
_rule_query(
    "rule_pickup_future",
    lambda: [rules.in_future("tpep_pickup_datetime", "pickup", AS_OF)],
    f"tpep_pickup_datetime > {AS_OF_SQL}",
    ("tpep_pickup_datetime",),
)
_rule_query(
    "rule_dropoff_future",
    lambda: [rules.in_future("tpep_dropoff_datetime", "dropoff", AS_OF)],
    f"tpep_dropoff_datetime > {AS_OF_SQL}",
    ("tpep_dropoff_datetime",),
)
_rule_query(
    "rule_dropoff_before_pickup",
    lambda: [rules.ends_before_start("tpep_pickup_datetime", "tpep_dropoff_datetime", "order")],
    "tpep_dropoff_datetime < tpep_pickup_datetime",
    ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
)
_rule_query(
    "rule_zero_values",
    lambda: [rules.zero("trip_distance"), rules.zero("fare_amount"), rules.zero("total_amount")],
    "trip_distance = 0 OR fare_amount = 0 OR total_amount = 0",
    ("trip_distance", "fare_amount", "total_amount"),
)
_rule_query(
    "rule_before_cutoff",
    lambda: [
        rules.before_cutoff("tpep_pickup_datetime", "pickup", CUTOFF),
        rules.before_cutoff("tpep_dropoff_datetime", "dropoff", CUTOFF),
    ],
    f"tpep_pickup_datetime < {CUTOFF_SQL} OR tpep_dropoff_datetime < {CUTOFF_SQL}",
    ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
)
_rule_query(
    "contract_not_null",
    lambda: [rules.Rule("any_null", any_null(CONTRACT.names))],
    " OR ".join(f"{c} IS NULL" for c in CONTRACT.names),
    tuple(c for c in CONTRACT.names if c != "payment_type"),
)
_rule_query(
    "contract_money_nonneg",
    lambda: rules.money_rules(CONTRACT),
    "fare_amount < 0 OR tip_amount < 0 OR total_amount < 0",
    ("fare_amount", "tip_amount", "total_amount"),
)
_rule_query(
    "contract_domain_flag",
    lambda: rules.domain_rules(CONTRACT),
    "store_and_fwd_flag NOT IN ('Y', 'N')",
    ("store_and_fwd_flag",),
)


def _long(counts: dict[str, str], label: str, source: str = "trips") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, COUNT(*) FILTER (WHERE {cond}) AS n FROM {source}"
        for name, cond in counts.items()
    )


@query(
    on_trips(
        "SELECT * FROM ("
        + _long(
            {
                "VendorID_lt_1": "VendorID < 1",
                "passenger_count_lt_0": "passenger_count < 0",
                "trip_distance_lt_0": "trip_distance < 0",
                "payment_type_lt_1": "payment_type < 1",
            },
            "rule",
        )
        + ")"
    )
)
def contract_min_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rule_counts(trips(spark, sf_dir), rules.minimum_rules(CONTRACT))


@query(
    on_trips(
        "SELECT trip_id, payment_type, PULocationID FROM trips WHERE PULocationID IS NOT NULL"
        " AND PULocationID NOT IN (SELECT n_nationkey FROM nation)"
    )
)
def contract_zone_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = trips(spark, sf_dir).select("trip_id", "payment_type", "PULocationID")
    return orphan_rows(fact, "PULocationID", load(spark, sf_dir, "nation"), "n_nationkey")


@query(
    on_trips(
        "SELECT * FROM ("
        + _long(
            {
                "passenger_count_gt_6": "passenger_count > 6",
                "trip_distance_gt_300": "trip_distance > 300",
                "total_amount_gt_1000": "total_amount > 1000",
            },
            "rule",
        )
        + ")"
    )
)
def warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rule_counts(trips(spark, sf_dir), rules.warning_rules(CONTRACT))


_CRITICAL_SQL = {
    **{f"{c}_null": f"{c} IS NULL" for c in CONTRACT.names},
    **{f"{c}_negative": f"{c} < 0" for c in ("fare_amount", "tip_amount", "total_amount")},
    "VendorID_lt_1": "VendorID < 1",
    "passenger_count_lt_0": "passenger_count < 0",
    "trip_distance_lt_0": "trip_distance < 0",
    "payment_type_lt_1": "payment_type < 1",
    "store_and_fwd_flag_domain": "store_and_fwd_flag NOT IN ('Y', 'N')",
    "tpep_dropoff_datetime_before_tpep_pickup_datetime": "tpep_dropoff_datetime < tpep_pickup_datetime",
}
_WARNING_SQL = {
    "passenger_count_gt_6": "passenger_count > 6",
    "trip_distance_gt_300": "trip_distance > 300",
    "total_amount_gt_1000": "total_amount > 1000",
}


@query(
    on_trips(
        "SELECT rule, severity, n, CASE WHEN n = 0 THEN 'none' WHEN severity = 'critical' THEN"
        " 'quarantine' ELSE 'log' END AS action FROM (SELECT *, 'critical' AS severity FROM ("
        + _long(_CRITICAL_SQL, "rule")
        + ") UNION ALL SELECT *, 'warning' FROM ("
        + _long(_WARNING_SQL, "rule")
        + "))"
    )
)
def contract_severity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.severity_report(trips(spark, sf_dir), rules.contract_rules(CONTRACT))


@query(
    on_trips(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS NULL) AS rows_without_value,"""
            " FALSE AS missing FROM trips"
            if c in TRIP_COLUMNS
            else f"""SELECT '{c}' AS "column", COUNT(*) AS rows_without_value, TRUE AS missing FROM trips"""
            for c in TRIP_CONTRACT.names
        )
        + ")"
    )
)
def contract_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.missing_columns(trips(spark, sf_dir), TRIP_CONTRACT)


@query(
    on_routed(
        f"SELECT {COLUMNS}, error_type AS _error_type, error_message AS _error_message,"
        f" {AS_OF_SQL} AS _failed_at FROM routed WHERE error_type = 'missing_critical_column'"
    )
)
def dlq_missing_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = routed_trips(spark, sf_dir).dead_letters
    missing = letters.where(F.col("_error_type") == ErrorType.MISSING_CRITICAL.value)
    return missing.drop(routing.SOURCE_FILE, routing.ORIGINAL)


PROFILE_SQL = {
    "trip_distance_negative": "trip_distance < 0",
    "fare_amount_negative": "fare_amount < 0",
    "total_amount_negative": "total_amount < 0",
    "tip_amount_negative": "tip_amount < 0",
    "trip_distance_zero": "trip_distance = 0",
    "fare_amount_zero": "fare_amount = 0",
    "total_amount_zero": "total_amount = 0",
    "passenger_count_gt_10": "passenger_count > 10",
    "pickup_in_future": f"tpep_pickup_datetime > {AS_OF_SQL}",
    "dropoff_in_future": f"tpep_dropoff_datetime > {AS_OF_SQL}",
    "pickup_before_cutoff": f"tpep_pickup_datetime < {CUTOFF_SQL}",
    "dropoff_before_cutoff": f"tpep_dropoff_datetime < {CUTOFF_SQL}",
    "dropoff_before_pickup": "tpep_dropoff_datetime < tpep_pickup_datetime",
}
ANY_INVALID = " OR ".join(f"coalesce({c}, FALSE)" for c in PROFILE_SQL.values())


@query(on_trips(f"SELECT {COLUMNS} FROM trips WHERE {ANY_INVALID}"))
def rows_any_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.invalid_rows(trips(spark, sf_dir), rules.profiling_rules(AS_OF, CUTOFF))


@query(on_trips("SELECT * FROM (" + _long(rules_sql(), "rule") + ")"))
def failed_rules_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rule_counts(trips(spark, sf_dir), cleaning_rules(AS_OF))


@query(
    on_trips(
        f"SELECT trip_id, payment_type, {named(rules_sql())} AS failed_rules FROM trips"
    )
)
def evaluated_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = validate.evaluate(trips(spark, sf_dir), cleaning_rules(AS_OF))
    return df.select(
        "trip_id", "payment_type", F.array_join("_failed_rules", ", ").alias("failed_rules")
    )


@query(
    on_trips(
        f"SELECT {COLUMNS}, rule, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER"
        f" (PARTITION BY rule ORDER BY {', '.join(f'{c} NULLS FIRST' for c in TRIP_COLUMNS)}) AS rank"
        " FROM ("
        + " UNION ALL ".join(
            f"SELECT *, '{name}' AS rule FROM trips WHERE {cond}" for name, cond in rules_sql().items()
        )
        + ")) WHERE rank <= 10"
    )
)
def rule_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten example rows for each cleaning rule."""
    return validate.examples_per_rule(trips(spark, sf_dir), cleaning_rules(AS_OF), 10)


@query(
    on_routed(
        f"SELECT {COLUMNS}, error_type AS _error_type, error_message AS _error_message,"
        f" {AS_OF_SQL} AS _failed_at FROM routed WHERE error_type IS NOT NULL"
    )
)
def dlq_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = routed_trips(spark, sf_dir).dead_letters
    return letters.drop(routing.SOURCE_FILE, routing.ORIGINAL)


@query(
    on_routed(
        "SELECT coalesce(error_type, 'silver') AS verdict, COUNT(*) AS n FROM routed GROUP BY 1"
        " UNION ALL SELECT 'duplicate', CAST(SUM(copies - 1) AS BIGINT) FROM routed"
    )
)
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed_trips(spark, sf_dir).verdict_counts()


@query(
    TRIPS
    + f", judged AS ({judge_sql('SELECT * FROM trips')}), good AS (SELECT * FROM judged WHERE error_type"
    f" IS NULL), kept AS ({dedup_sql('good')}) SELECT error_type AS verdict, COUNT(*) AS n FROM judged"
    " WHERE error_type IS NOT NULL GROUP BY 1 UNION ALL SELECT 'silver', COUNT(*) FROM kept UNION ALL"
    " SELECT 'duplicate', CAST(SUM(copies - 1) AS BIGINT) FROM kept"
)
def route_counts_validate_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judging before deduplication: copies of rejected rows stay dead letters."""
    return routed_trips(spark, sf_dir, validate_first=True).verdict_counts()


@query(on_routed("SELECT trip_id, payment_type, data_quality_score FROM silver"))
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed_trips(spark, sf_dir).silver.select(
        "trip_id", "payment_type", "data_quality_score"
    )


@query(on_routed("SELECT data_quality_score, COUNT(*) AS n FROM silver GROUP BY 1"))
def quality_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = routed_trips(spark, sf_dir).silver
    return silver.groupBy("data_quality_score").agg(F.count(F.lit(1)).alias("n"))


@query(
    on_routed(
        f"SELECT {COLUMNS}, {AS_OF_SQL} AS processing_timestamp, data_quality_score FROM silver"
    )
)
def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed_trips(spark, sf_dir).silver


_TYPED = (
    "SELECT * REPLACE (CASE WHEN store_and_fwd_flag = 'X' THEN NULL ELSE payment_type END AS payment_type,"
    " CASE WHEN PULocationID = 25 THEN NULL ELSE passenger_count END AS passenger_count), "
    + named({"passenger_count": "PULocationID = 25", "payment_type": "store_and_fwd_flag = 'X'"})
    + " AS type_errors FROM trips"
)


@query(
    TRIPS
    + f""", typed AS ({_TYPED}),
kept AS ({dedup_sql('typed', keys=KEYS + ', type_errors', rest=REST)}),
routed AS (SELECT * REPLACE (CASE WHEN type_errors <> '' THEN 'type_error' ELSE error_type END
  AS error_type) FROM ({judge_sql('SELECT * FROM kept')})),
silver AS (SELECT * FROM routed WHERE error_type IS NULL),
checks AS (
 SELECT '1_reading' AS layer, 'type_error' AS "check",
   (SELECT COUNT(*) FROM routed WHERE error_type = 'type_error') AS failures
 UNION ALL SELECT '2_rules', 'missing_critical',
   (SELECT COUNT(*) FROM routed WHERE error_type = 'missing_critical_column')
 UNION ALL SELECT '2_rules', 'business_rule',
   (SELECT COUNT(*) FROM routed WHERE error_type = 'business_rule_failed')
 UNION ALL SELECT '2_rules', 'indeterminate',
   (SELECT COUNT(*) FROM routed WHERE error_type = 'rule_indeterminate')
 UNION ALL SELECT '3_aggregation', 'unreconciled',
   (SELECT COUNT(*) FROM trips) - (SELECT CAST(SUM(copies) AS BIGINT) FROM routed)
 UNION ALL SELECT '4_consumption', 'empty',
   (SELECT CASE WHEN COUNT(*) > 0 THEN 0 ELSE 1 END FROM silver)
 UNION ALL SELECT '4_consumption', 'stale',
   (SELECT CASE WHEN date_diff('day', max(tpep_pickup_datetime), {AS_OF_SQL}) <= 31 THEN 0 ELSE 1 END
    FROM silver)
 UNION ALL SELECT '4_consumption', 'absent_zones',
   (SELECT COUNT(*) FROM nation WHERE n_nationkey NOT IN (SELECT PULocationID FROM silver)))
SELECT layer, "check", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM checks
"""
)
def layered_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored layers of one run over text, against a count of the raw rows."""

    def fill(layers: Layers) -> None:
        pipeline.run(spark, normalize_checked(text_trips(spark, sf_dir), TRIP_TYPES), layers, AS_OF)

    layers = layers_of(spark, sf_dir, "layers-text", fill)
    return layered_report(
        text_trips(spark, sf_dir),
        pipeline.read_layer(spark, layers.silver),
        pipeline.read_layer(spark, layers.dead_letters),
        spark.read.parquet(layers.metrics),
        "tpep_pickup_datetime",
        "PULocationID",
        load(spark, sf_dir, "nation"),
        "n_nationkey",
        AS_OF,
        sla_days=31,
    )


@query(
    on_routed(
        """
SELECT CAST(SUM(copies) AS BIGINT) AS input_rows, CAST(SUM(copies - 1) AS BIGINT) AS duplicate_rows,
  CAST(0 AS BIGINT) AS schema_mismatch_rows, CAST(0 AS BIGINT) AS type_error_rows,
  COUNT(*) FILTER (WHERE error_type = 'missing_critical_column') AS missing_critical_rows,
  COUNT(*) FILTER (WHERE error_type = 'business_rule_failed') AS business_rule_rows,
  COUNT(*) FILTER (WHERE error_type = 'rule_indeterminate') AS indeterminate_rows,
  COUNT(*) FILTER (WHERE error_type IS NOT NULL) AS dlq_rows,
  COUNT(*) FILTER (WHERE error_type IS NULL) AS silver_rows,
  COUNT(*) FILTER (WHERE error_type IS NOT NULL) * CAST(100 AS DOUBLE) / CAST(SUM(copies) AS DOUBLE)
    AS failure_rate,
  TIMESTAMP '2001-01-01 00:00:00' AS run_ts
FROM routed
"""
    )
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed_trips(spark, sf_dir).metrics()


@query(
    on_routed(
        "SELECT 'input' AS step, CAST(SUM(copies) AS BIGINT) AS n FROM routed"
        " UNION ALL SELECT 'after_dedup', COUNT(*) FROM routed"
        " UNION ALL SELECT 'after_null_check', COUNT(*) FROM routed"
        " WHERE error_type IS DISTINCT FROM 'missing_critical_column'"
        " UNION ALL SELECT 'after_rules', COUNT(*) FROM routed WHERE error_type IS NULL"
    )
)
def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after each cleaning step, from the one row of run metrics."""
    m = routed_trips(spark, sf_dir).metrics()
    deduped = F.col("input_rows") - F.col("duplicate_rows")
    steps = m.select(
        F.col("input_rows").alias("input"),
        deduped.alias("after_dedup"),
        (deduped - F.col("missing_critical_rows")).alias("after_null_check"),
        F.col("silver_rows").alias("after_rules"),
    )
    return steps.unpivot([], steps.columns, "step", "n")


@query(
    on_routed(
        "SELECT * FROM (SELECT coalesce(error_type, 'recovered') AS verdict, COUNT(*) AS n FROM ("
        + judge_sql(
            f"SELECT {COLUMNS} FROM routed WHERE error_type IS NOT NULL", max_passengers=11
        )
        + ") GROUP BY 1)"
    )
)
def dlq_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters judged again with a passenger limit of 11."""
    again = routing.reprocess(
        routed_trips(spark, sf_dir).dead_letters,
        CRITICAL_COLUMNS,
        FILL_DEFAULTS,
        cleaning_rules(AS_OF, passengers=(None, 11)),
        AS_OF,
    )
    verdict = F.coalesce(routing.ERROR_TYPE, F.lit("recovered")).alias("verdict")
    return again.rows.groupBy(verdict).agg(F.count(F.lit(1)).alias("n"))
