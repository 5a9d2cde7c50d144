"""Queries for duplicates and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions import rules
from silverlode.functions.contract import CRITICAL_COLUMNS, DEDUP_KEYS
from silverlode.operators import dedup as duplicates
from silverlode.operators import monitor, profile
from silverlode.operators.validate import rule_counts, rule_counts_wide
from silverlode.plans.inputs import load, routed_trips, trips
from silverlode.plans.oracle import (
    COLUMNS,
    CRITICAL,
    dedup_sql,
    on_routed,
    on_survivors,
    on_trips,
)
from silverlode.plans.registry import query
from silverlode.plans.rule_queries import ANY_INVALID, PROFILE_SQL
from silverlode.plans.trips import AS_OF, CUTOFF, TRIP_COLUMNS
from silverlode.sources import footers

ANY_NULL = " OR ".join(f"{c} IS NULL" for c in TRIP_COLUMNS)
OTHERS = ", ".join(f"{c} NULLS FIRST" for c in TRIP_COLUMNS if c != "trip_id")


@query(on_survivors(f"SELECT {COLUMNS}, copies FROM survivors"))
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dedup(trips(spark, sf_dir), DEDUP_KEYS, copies="copies")


@query(
    on_trips(f"SELECT {COLUMNS} FROM ({dedup_sql('trips', keys='trip_id', rest=OTHERS)})")
)
def dedup_trip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dedup(trips(spark, sf_dir), ["trip_id"])


@query(on_trips(f"SELECT DISTINCT {COLUMNS} FROM trips"))
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).distinct()


@query(
    on_trips(
        f"SELECT (SELECT COUNT(*) FROM trips) - (SELECT COUNT(*) FROM (SELECT DISTINCT {COLUMNS} FROM"
        " trips)) AS duplicate_rows"
    )
)
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_summary(trips(spark, sf_dir)).select("duplicate_rows")


@query(on_trips(f"SELECT {COLUMNS}, COUNT(*) AS n FROM trips GROUP BY ALL HAVING COUNT(*) > 1"))
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_groups(trips(spark, sf_dir))


@query(on_trips("SELECT trip_id, COUNT(*) AS n FROM trips GROUP BY trip_id HAVING COUNT(*) > 1"))
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_groups(trips(spark, sf_dir), ["trip_id"])


@query(
    "SELECT sha256(text) AS text_hash, COUNT(*) AS n FROM documents GROUP BY 1 HAVING COUNT(*) > 1"
)
def duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal documents. Whole texts are hashed where they lie; only hashes are shuffled."""
    hashed = load(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_hash"))
    return duplicates.duplicate_groups(hashed)


@query(
    on_trips(
        f"""
SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows,
  CAST(total_rows - distinct_rows AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total_rows AS DOUBLE)
    AS duplicate_percent,
  CAST(total_rows - distinct_rows AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total_rows AS DOUBLE) > 0.1
    AS alert
FROM (SELECT (SELECT COUNT(*) FROM trips) AS total_rows,
  (SELECT COUNT(*) FROM (SELECT DISTINCT {COLUMNS} FROM trips)) AS distinct_rows)
"""
    )
)
def duplicate_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_summary(trips(spark, sf_dir), threshold_percent=0.1)


@query(
    on_trips(
        f"SELECT {COLUMNS}, COUNT(*) AS n FROM trips GROUP BY ALL HAVING COUNT(*) > 1 ORDER BY n DESC,"
        + ", ".join(f"{c} NULLS FIRST" for c in TRIP_COLUMNS)
        + " LIMIT 10"
    )
)
def top_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_groups(trips(spark, sf_dir)).limit(10)


@query("SELECT COUNT(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footers.row_counts(spark, f"{sf_dir}/lineitem.parquet")


@query(
    on_trips(
        "SELECT "
        + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in TRIP_COLUMNS)
        + " FROM trips"
    )
)
def null_counts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(trips(spark, sf_dir))


def _null_report_sql(columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,"""
        f" CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * CAST(100 AS DOUBLE)"
        " / CAST(COUNT(*) AS DOUBLE) AS null_percentage FROM trips"
        for c in columns
    )


@query(on_trips("SELECT * FROM (" + _null_report_sql(TRIP_COLUMNS) + ")"))
def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_report(trips(spark, sf_dir))


@query(
    on_trips("SELECT *, null_percentage > 2 AS alert FROM (" + _null_report_sql(CRITICAL) + ")")
)
def null_rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_alerts(trips(spark, sf_dir), CRITICAL_COLUMNS, 2.0)


@query(
    on_trips(
        "SELECT "
        + ", ".join(f"COUNT(*) FILTER (WHERE {c}) AS {n}" for n, c in PROFILE_SQL.items())
        + " FROM trips"
    )
)
def value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts_wide(trips(spark, sf_dir), rules.profiling_rules(AS_OF, CUTOFF))


@query(
    on_trips(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{n}' AS "check", COUNT(*) FILTER (WHERE {c}) AS n FROM trips"""
            for n, c in PROFILE_SQL.items()
        )
        + ")"
    )
)
def value_checks_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rule_counts(trips(spark, sf_dir), rules.profiling_rules(AS_OF, CUTOFF), "check")
    return found.orderBy("check")


@query(
    on_trips(
        f"""
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {ANY_NULL}) AS rows_any_null,
  COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {COLUMNS} FROM trips)) AS duplicate_rows,
  COUNT(*) FILTER (WHERE {ANY_INVALID}) AS rows_any_invalid,
  COUNT(*) FILTER (WHERE {ANY_NULL} OR {ANY_INVALID}) AS bad_rows,
  COUNT(*) FILTER (WHERE NOT ({ANY_NULL} OR {ANY_INVALID})) AS clean_rows
FROM trips
"""
    )
)
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quality_summary(trips(spark, sf_dir), rules.profiling_rules(AS_OF, CUTOFF))


_RANGED = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")


@query(
    on_trips(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", MIN({c}) AS min_value, MAX({c}) AS max_value,"""
            f" CAST(SUM(CAST({c} AS DECIMAL(38,10))) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE) AS mean_value"
            " FROM trips"
            for c in _RANGED
        )
        + ")"
    )
)
def value_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_ranges(trips(spark, sf_dir), _RANGED)


_RANGED_LINES = ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", MIN({c})::DOUBLE AS min_value, MAX({c})::DOUBLE AS max_value,"""
        f" CAST(SUM(CAST({c} AS DECIMAL(38,10))) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE) AS mean_value FROM lineitem"
        for c in _RANGED_LINES
    )
    + ")"
)
def value_ranges_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are no money: whole numbers, and fractions below one."""
    return profile.value_ranges(load(spark, sf_dir, "lineitem"), _RANGED_LINES)


@query(
    on_trips(
        "SELECT COALESCE(SUM(n), 0)::BIGINT AS n_rows, COUNT(*) AS n_distinct, COUNT(*) FILTER (WHERE n > 1) AS"
        " n_repeated_keys, COUNT(*) FILTER (WHERE n > 1) = 0 AS passed FROM (SELECT trip_id, COUNT(*) AS n"
        " FROM trips WHERE trip_id IS NOT NULL GROUP BY 1)"
    )
)
def test_unique_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that is not unique."""
    return profile.uniqueness(trips(spark, sf_dir), "trip_id")


@query(
    "SELECT COALESCE(SUM(n), 0)::BIGINT AS n_rows, COUNT(*) AS n_distinct, COUNT(*) FILTER (WHERE n > 1) AS"
    " n_repeated_keys, COUNT(*) FILTER (WHERE n > 1) = 0 AS passed FROM (SELECT o_orderkey, COUNT(*) AS n"
    " FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1)"
)
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.uniqueness(load(spark, sf_dir, "orders"), "o_orderkey")


@query(
    on_trips(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS NULL) AS failures,"""
            f" COUNT(*) FILTER (WHERE {c} IS NULL) = 0 AS passed FROM trips"
            for c in CRITICAL
        )
        + ")"
    )
)
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.not_null_test(trips(spark, sf_dir), CRITICAL_COLUMNS)


@query(
    on_routed(
        "SELECT error_type AS _error_type, COUNT(*) AS n FROM routed WHERE error_type IS NOT NULL GROUP BY 1"
    )
)
def dlq_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.triage(routed_trips(spark, sf_dir).dead_letters)


@query(
    on_routed(
        "SELECT error_type AS _error_type, CAST(rank AS INT) AS rank, trip_id, payment_type,"
        " error_message AS _error_message FROM (SELECT *,"
        " row_number() OVER (PARTITION BY error_type ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in TRIP_COLUMNS)
        + ") AS rank FROM routed WHERE error_type IS NOT NULL) WHERE rank <= 5"
    )
)
def dlq_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = routed_trips(spark, sf_dir).dead_letters
    return monitor.samples_per_type(letters, 5, list(TRIP_COLUMNS)).select(
        "_error_type", "rank", "trip_id", "payment_type", "_error_message"
    )
