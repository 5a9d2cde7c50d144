"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest
from compare import differences

from silverlode.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, small, duck, name):
    assert differences(QUERIES[name](spark, small), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_files_per_partition_account_for_all_rows(spark, small):
    files = QUERIES["partition_files"](spark, small).agg({"n": "sum"}).first()[0]
    assert files == spark.read.parquet(f"{small}/lineitem.parquet").count()


def test_source_files_account_for_all_rows(spark, small):
    counts = QUERIES["source_file_counts"](spark, small).collect()
    assert sum(r.n for r in counts) == spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert [r.source for r in counts] == ["lineitem.parquet"]


def test_entry(spark):
    import __spark_entry__ as entry

    counts = {r.verdict: r.n for r in entry.entry(spark).collect()}
    assert counts == {
        "duplicate": 242,
        "missing_critical_column": 149,
        "business_rule_failed": 1742,
        "rule_indeterminate": 109,
        "silver": 4000,
    }
    assert set(entry.oracle_sql()) <= set(entry.queries())
