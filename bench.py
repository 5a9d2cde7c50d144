"""Timings of the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
               Each table is dealt to as many files as there are threads first.
BENCH_RUNS     timed runs per query, the best one counts (default 2)
BENCH_COPIES   the trips are multiplied by this number, written as Parquet and sent through the pipeline, cold
               and warm (default 26, which makes 16.2 million rows of sf0.1; 0 leaves this out)
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from silverlode.plans import catalog, pipeline  # noqa: E402
from silverlode.plans.inputs import load, trips  # noqa: E402
from silverlode.plans.trips import AS_OF  # noqa: E402
from silverlode.session import Settings, build_session, delete_path, scratch_path  # noqa: E402
from silverlode.sinks.writers import write_csv  # noqa: E402
from silverlode.sources.readers import read_csv  # noqa: E402

HEADLINE = (
    "route_counts",
    "silver_trips",
    "dlq_rows",
    "run_metrics",
    "layered_validation",
    "dedup_keys",
    "distinct_rows",
    "duplicate_groups",
    "null_report",
    "value_checks",
    "quality_summary",
    "contract_severity_summary",
    "gold_daily_revenue_by_zone",
    "fact_trips",
    "erase_subjects",
    "pseudonymize",
    "missing_dimensions",
    "dlq_samples",
    "prune_month",
    "prune_columns",
)


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def drain(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def best(runs: int, action: Callable[[], None]) -> float:
    seconds = []
    for _ in range(runs):
        started = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - started)
    return round(min(seconds), 3)


def in_several_files(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The given tables, one file each, in as many files as there are threads, as a lake would have them."""
    root = scratch_path(spark, "bench-tables")
    for name in TABLES:
        load(spark, sf_dir, name).repartition(files).write.parquet(f"{root}/{name}.parquet")
    return root


def yardstick(spark: SparkSession) -> None:
    """Work that never changes, so that rounds on different machines can be compared."""
    numbers = spark.range(40_000_000).select((F.col("id") % 100_003).alias("k"), F.hash("id").alias("v"))
    drain(numbers.groupBy("k").agg(F.sum("v"), F.max("v")))


def run_pipeline(spark: SparkSession, bronze: DataFrame, as_of: str) -> dict:
    root = scratch_path(spark, "bench-lake")
    layers = pipeline.Layers(f"{root}/silver", f"{root}/dlq", f"{root}/gold", f"{root}/metrics")
    metrics = pipeline.run(spark, bronze, layers, as_of)
    delete_path(spark, root)
    return metrics


def multiplied(spark: SparkSession, df: DataFrame, copies: int, path: str) -> DataFrame:
    """Copies that differ in the deduplication key, so that the share of duplicates stays the same."""
    shift = F.col("_copy")
    widened = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    moved = widened.withColumns(
        {
            "trip_id": F.col("trip_id") + shift.cast("bigint") * 100_000_000,
            "tpep_pickup_datetime": F.timestamp_add("SECOND", shift, F.col("tpep_pickup_datetime")),
            "tpep_dropoff_datetime": F.timestamp_add("SECOND", shift, F.col("tpep_dropoff_datetime")),
            "total_amount": F.col("total_amount") + shift * 0.01,
        }
    )
    moved.drop("_copy").repartition(32).write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    copies = int(os.environ.get("BENCH_COPIES", "26"))
    spark = build_session(
        Settings(
            app_name="bench",
            master=f"local[{cpus}]",
            shuffle_partitions=cpus,
            driver_memory="16g",
        )
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    timings: dict[str, float] = {}
    yard = best(runs, lambda: yardstick(spark))
    sf_name, sf_dir = os.path.basename(sf_dir.rstrip("/")), in_several_files(spark, sf_dir, cpus)
    # The table by month that the pruning queries read is written by the first of them.
    timings["write_by_month"] = best(1, lambda: drain(queries["prune_month"](spark, sf_dir)))
    # So are the layers that the layered report reads.
    timings["write_layers"] = best(1, lambda: drain(queries["layered_validation"](spark, sf_dir)))
    for name in HEADLINE:
        timings[name] = best(runs, lambda: drain(queries[name](spark, sf_dir)))

    orders = load(spark, sf_dir, "orders")
    csv_path = scratch_path(spark, "bench-orders")
    write_csv(orders, csv_path)
    timings["csv_explicit_schema"] = best(
        runs, lambda: drain(read_csv(spark, csv_path, orders.schema))
    )
    timings["csv_inferred_schema"] = best(runs, lambda: drain(read_csv(spark, csv_path)))
    timings["one_column_csv"] = best(
        runs, lambda: drain(read_csv(spark, csv_path, orders.schema).select("o_totalprice"))
    )
    timings["one_column_parquet"] = best(runs, lambda: drain(orders.select("o_totalprice")))
    delete_path(spark, csv_path)

    rows = {}

    def whole_pipeline() -> None:
        rows["pipeline"] = run_pipeline(spark, trips(spark, sf_dir), AS_OF)["input_rows"]

    timings["pipeline"] = best(runs, whole_pipeline)
    result = {
        "metric": "total time of headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_name.removeprefix("sf"),
        "yardstick": yard,
        "cpus": cpus,
        "pipeline_rows": rows["pipeline"],
        "pipeline_rows_per_sec": round(rows["pipeline"] / timings["pipeline"]),
    }
    if copies:
        path = scratch_path(spark, "bench-bronze")
        bronze = multiplied(spark, trips(spark, sf_dir), copies, path)

        def large_pipeline() -> None:
            rows["large"] = run_pipeline(spark, bronze, "2002-06-01 00:00:00")["input_rows"]

        spark.conf.set("spark.sql.shuffle.partitions", 4 * cpus)
        cold, warm = best(1, large_pipeline), best(1, large_pipeline)
        result["large_pipeline"] = {
            "rows": rows["large"],
            "cold_sec": cold,
            "sec": warm,
            "rows_per_sec": round(rows["large"] / warm),
        }
        delete_path(spark, path)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
