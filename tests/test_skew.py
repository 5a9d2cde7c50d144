"""Whole tables in which one order, customer, day and text hold a third of the rows, joined by shuffle."""

from __future__ import annotations

import duckdb
import pytest
from compare import TABLES, connect, differences
from conftest import SMALL, plan_of

from silverlode.operators.relations import enrich
from silverlode.plans import catalog

SKEWED = {
    "lineitem": """
SELECT * REPLACE (
  CASE WHEN l_linenumber % 3 = 0 THEN 50 ELSE l_orderkey END AS l_orderkey,
  CASE WHEN l_linenumber % 3 = 0 THEN 25 ELSE l_partkey END AS l_partkey,
  CASE WHEN l_linenumber % 3 = 0 THEN 5.0 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_linenumber % 3 = 0 THEN 1000.0 ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN l_linenumber % 3 = 0 THEN 0.02 ELSE l_tax END AS l_tax,
  CASE WHEN l_linenumber % 3 = 0 THEN TIMESTAMP '1997-03-05' ELSE l_shipdate END AS l_shipdate) FROM t
""",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM t",
    "events": """
SELECT * REPLACE (
  CASE WHEN event_id % 3 = 0 THEN 'error' ELSE event_type END AS event_type,
  CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 03:00:00' ELSE ts END AS ts) FROM t
""",
    "documents": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'same' ELSE text END AS text) FROM t",
}
CORE = (
    "route_counts",
    "silver_trips",
    "dlq_rows",
    "dlq_samples",
    "rule_examples",
    "dedup_keys",
    "dedup_trip_id",
    "duplicate_groups",
    "duplicate_texts",
    "quality_summary",
    "layered_validation",
    "gold_daily_revenue_by_zone",
    "fact_trips",
    "enrich_zone",
    "fk_report",
    "erase_subjects",
    "erase_hashed_subjects",
    "missing_dimensions",
    "dlq_by_day",
    "revenue_vs_7d",
    "sink_partitioned_roundtrip",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory) -> str:
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE OR REPLACE VIEW t AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')"
        )
        connection.execute(
            f"COPY ({SKEWED.get(table, 'SELECT * FROM t')}) TO '{folder}/{table}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.fixture(scope="module")
def by_shuffle(spark):
    names = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    saved = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("-1", "16k", "16k")):
        spark.conf.set(name, value)
    yield spark
    for name, value in saved.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("name", CORE)
def test_skewed_tables_give_the_same_result(by_shuffle, skewed, name):
    df = catalog.queries()[name](by_shuffle, skewed)
    assert differences(df, connect(skewed), catalog.oracle_sql()[name]) == []


def test_hot_rows_of_a_join_are_split(by_shuffle, skewed):
    """AQE cuts the hot order over several tasks."""
    lines = by_shuffle.read.parquet(f"{skewed}/lineitem.parquet").repartition(8)
    orders = by_shuffle.read.parquet(f"{skewed}/orders.parquet")
    saved = by_shuffle.conf.get("spark.sql.shuffle.partitions")
    by_shuffle.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        joined = enrich(lines, "l_orderkey", orders, "o_orderkey", {"status": "o_orderstatus"})
        assert joined.count() == lines.count()
        joined.collect()
        assert "skew=true" in plan_of(joined, "simple")
    finally:
        by_shuffle.conf.set("spark.sql.shuffle.partitions", saved)
