from __future__ import annotations

import glob
import os

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from silverlode.session import delete_path, scratch_path, scratch_root
from silverlode.sinks import writers
from silverlode.sources import footers


@pytest.fixture(scope="module")
def by_month(spark, small, tmp_path_factory) -> str:
    path = str(tmp_path_factory.mktemp("lines") / "t")
    writers.write_by_month(spark.read.parquet(f"{small}/lineitem.parquet"), path, "l_shipdate")
    return path


@pytest.mark.parametrize("codec, mark", [("snappy", "snappy"), ("gzip", "gz"), ("zstd", "zstd")])
def test_codec(spark, tmp_path, codec, mark):
    path = str(tmp_path / codec)
    writers.write_parquet(spark.range(10), path, codec=codec)
    assert glob.glob(f"{path}/*.{mark}.parquet")


def test_uncompressed_and_unknown_codec(spark, tmp_path):
    path = str(tmp_path / "none")
    writers.write_parquet(spark.range(10), path, codec="none")
    names = [os.path.basename(f) for f in glob.glob(f"{path}/*.parquet")]
    assert names and not any(mark in n for n in names for mark in (".snappy", ".gz", ".zstd"))
    with pytest.raises(ValueError):
        writers.write_parquet(spark.range(1), path, codec="rar")


def test_one_file_per_small_month(spark, small, by_month):
    months = glob.glob(f"{by_month}/year=*/month=*")
    files = glob.glob(f"{by_month}/year=*/month=*/*.parquet")
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    expected = lines.select(F.year("l_shipdate"), F.month("l_shipdate")).distinct().count()
    assert len(months) == expected
    assert len(files) == len(months)


def test_a_hot_partition_is_cut_into_several_files(spark, tmp_path):
    """One month holds nearly all rows; it must not end in a single task."""
    df = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, 2).otherwise(1).alias("month"),
        F.lit(2024).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    saved = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        writers.write_parquet(df, str(tmp_path / "t"), partition_by=("year", "month"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", saved)
    assert len(glob.glob(f"{tmp_path}/t/year=2024/month=1/*.parquet")) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000


def test_month_filter_prunes_folders(spark, by_month):
    df = spark.read.parquet(by_month).where((F.col("year") == 1997) & (F.col("month") == 3))
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan


def test_date_range_prunes_folders_and_pushes_the_dates(spark, by_month):
    df = writers.in_date_range(spark.read.parquet(by_month), "l_shipdate", "1996-11-15", "1997-02-10")
    plan = plan_of(df)
    partition_filters = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "year" in partition_filters and "month" in partition_filters
    assert "GreaterThanOrEqual(l_shipdate,1996-11-15T00:00)" in plan
    assert {(r.year, r.month) for r in df.collect()} <= {(1996, 11), (1996, 12), (1997, 1), (1997, 2)}


def test_only_needed_columns_are_read(spark, by_month):
    df = spark.read.parquet(by_month).select("l_extendedprice").where("l_extendedprice > 50000")
    assert "ReadSchema: struct<l_extendedprice:double>" in plan_of(df)
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,50000.0)]" in plan_of(df)


def test_dynamic_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, year int, month int")
    writers.write_parquet(first, path, partition_by=("year", "month"))
    again = spark.createDataFrame([(9, 2024, 2)], "v int, year int, month int")
    writers.write_parquet(again, path, partition_by=("year", "month"), dynamic=True)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]
    with pytest.raises(ValueError):
        writers.write_parquet(again, path, dynamic=True)


def test_expired_days_are_listed_and_dropped(spark, tmp_path):
    path = str(tmp_path / "dlq")
    days = spark.sql(
        "SELECT id AS v, timestampadd(DAY, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01') AS _failed_at"
        " FROM range(40)"
    )
    writers.write_dead_letters(days, path)
    listed = writers.drop_expired_days(spark, path, "2024-02-05", keep_days=30)
    assert [f.removeprefix(path) for f in listed] == [
        f"/year=2024/month=1/day={d}" for d in (1, 2, 3, 4, 5)
    ]
    assert spark.read.parquet(path).count() == 40
    writers.drop_expired_days(spark, path, "2024-02-05", keep_days=30, dry_run=False)
    assert spark.read.parquet(path).count() == 35


def test_cached_frame_is_in_the_plan_and_let_go(spark):
    df = spark.range(100)
    with writers.cached(df) as held:
        assert held.count() == 100
        assert "InMemoryRelation" in held._jdf.queryExecution().withCachedData().toString()
    assert not df.storageLevel.useMemory


def test_scratch_follows_the_session(spark):
    root = scratch_root(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or root == shared.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)
    spark.range(3).write.parquet(a)
    assert delete_path(spark, a) and not delete_path(spark, a)


def test_figures_of_a_table_open_no_column(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.write_parquet(spark.range(100).selectExpr("id", "CAST(id % 4 AS INT) AS m"), path, partition_by=["m"])
    counted = footers.row_counts(spark, path, ["m"])
    plan = plan_of(counted)
    assert "PushedAggregation: [COUNT(*)]" in plan and "id" not in plan.split("ReadSchema")[1].split("\n")[0]
    listed = footers.file_list(spark, path)
    assert "ReadSchema: struct<length:bigint>" in plan_of(listed.select("m", "length")) or "content" not in plan_of(listed.select("m", "length")).split("ReadSchema")[1]
    found = {r.m: (r.n, r.files, r.bytes > 0) for r in footers.partition_files(spark, path, ["m"]).collect()}
    assert found == {m: (25, 1, True) for m in range(4)}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert footers.row_counts(spark, path).first().n == 100
