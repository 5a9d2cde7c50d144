"""Command line: ``spark-submit`` or ``python -m silverlode <command>``.

Paths may be on any file system the session can reach; credentials and tuning are passed as Spark settings.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession

from silverlode.functions.contract import EARLIEST_PICKUP, TRIP_CONTRACT
from silverlode.functions.rules import cleaning_rules, profiling_rules
from silverlode.operators.clean import normalize_checked
from silverlode.operators.privacy import PiiClass
from silverlode.plans import pipeline
from silverlode.plans.report import quality_report, render
from silverlode.session import Settings, build_session
from silverlode.sinks.writers import parquet_to_csv
from silverlode.sources import readers


def read_trips(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """A delivery in any format, typed by the contract, with lineage and the text of unreadable rows."""
    schema = TRIP_CONTRACT.to_struct()
    if kind == "csv":
        return readers.read_csv(spark, paths, schema, keep_corrupt=True, lineage=True, keep_named=True)
    if kind == "json":
        return readers.read_json(spark, paths, schema, keep_corrupt=True, lineage=True)
    df = readers.read_months(spark, paths, TRIP_CONTRACT.types(), lineage=True)
    return normalize_checked(df, TRIP_CONTRACT.types())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="silverlode")
    commands = top.add_subparsers(dest="command", required=True)
    kinds = ("parquet", "csv", "json")

    route = commands.add_parser("route", help="raw files to the clean and dead-letter layers")
    route.add_argument("paths", nargs="+")
    route.add_argument("--format", choices=kinds, default="parquet")
    route.add_argument("--silver", required=True)
    route.add_argument("--dead-letters", required=True)
    route.add_argument("--gold")
    route.add_argument("--metrics")
    route.add_argument("--run-ts", help="'yyyy-MM-dd HH:mm:ss' in UTC; now if left out")
    route.add_argument("--validate-first", action="store_true")
    route.add_argument("--delivery", help="what the run replaces; by default all that runs without it wrote")
    route.add_argument(
        "--contract",
        choices=("full", "present", "none"),
        default="full",
        help="rules of the contract: all, those about delivered columns, or none",
    )
    route.add_argument("--zones", help="Parquet with the known zone keys in its first column")
    route.add_argument("--hash", nargs="*", default=[], metavar="COLUMN", help="columns to replace by a hash")
    route.add_argument("--salt-env", help="environment variable that holds the salt of the hashes")
    route.add_argument("--halt-above", type=float, help="percent of failed rows")

    again = commands.add_parser("reprocess", help="judge dead letters under another passenger limit")
    again.add_argument("--silver", required=True)
    again.add_argument("--dead-letters", required=True)
    again.add_argument("--max-passengers", type=float, required=True)
    again.add_argument("--min-passengers", type=float, help="any number above zero if left out")
    again.add_argument("--gold")
    again.add_argument("--metrics")
    again.add_argument("--hash", nargs="*", default=[], metavar="COLUMN", help="columns that the layers hold hashed")
    again.add_argument("--salt-env", help="environment variable that holds the salt of the hashes")
    again.add_argument("--reread", action="store_true", help="read unreadable rows again from their text")
    again.add_argument("--run-ts")

    report = commands.add_parser("report", help="NULLs, duplicates and value checks of raw files")
    report.add_argument("paths", nargs="+")
    report.add_argument("--format", choices=kinds, default="csv")
    report.add_argument("--run-ts")
    report.add_argument("--cutoff", default=EARLIEST_PICKUP)
    report.add_argument("--examples", type=int, default=10)

    convert = commands.add_parser("convert", help="Parquet to CSV")
    convert.add_argument("source")
    convert.add_argument("target")

    show = commands.add_parser("show", help="columns, row count and a sample")
    show.add_argument("paths", nargs="+")
    show.add_argument("--format", choices=kinds, default="parquet")
    show.add_argument("--rows", type=int, default=10)
    return top


def execute(spark: SparkSession, args: argparse.Namespace) -> str:
    """Run one command and return what it has to say."""
    run_ts = getattr(args, "run_ts", None) or pipeline.run_timestamp()
    if args.command == "route":
        layers = pipeline.Layers(args.silver, args.dead_letters, args.gold, args.metrics)
        bronze = read_trips(spark, args.paths, args.format)
        salt = os.environ[args.salt_env] if args.salt_env else None
        contract = None if args.contract == "none" else TRIP_CONTRACT
        if args.contract == "present":
            contract = contract.restricted_to(bronze.columns)
        metrics = pipeline.run(
            spark,
            bronze,
            layers,
            run_ts,
            delivery=args.delivery or pipeline.WHOLE,
            policy={c: PiiClass.HIGH for c in args.hash} or None,
            salt=salt,
            validate_first=args.validate_first,
            contract=contract,
            zones=spark.read.parquet(args.zones) if args.zones else None,
            halt_above=args.halt_above,
        )
        return json.dumps(metrics, default=str)
    if args.command == "reprocess":
        layers = pipeline.Layers(args.silver, args.dead_letters, args.gold, args.metrics)
        types = TRIP_CONTRACT.types() if args.reread else None
        rules = cleaning_rules(run_ts, passengers=(args.min_passengers, args.max_passengers))
        policy = {c: PiiClass.HIGH for c in args.hash} or None
        salt = os.environ[args.salt_env] if args.salt_env else None
        return json.dumps(pipeline.reprocess_dead_letters(spark, layers, run_ts, rules, types=types, policy=policy, salt=salt))
    if args.command == "convert":
        parquet_to_csv(spark, args.source, args.target)
        return f"wrote {args.target}"
    df = read_trips(spark, args.paths, args.format)
    df = df.select(*[c for c in TRIP_CONTRACT.names if c in df.columns])
    if args.command == "report":
        rules = profiling_rules(run_ts, args.cutoff)
        return render(quality_report(df, rules, args.examples))
    # Any rows will do for a look; the ordered sample would sort the table.
    rows = [json.dumps(r.asDict(), default=str) for r in df.limit(args.rows).collect()]
    return "\n".join([", ".join(df.columns), *rows, f"rows: {df.count()}"])


def main() -> None:
    args = parser().parse_args()
    spark = build_session(Settings(app_name=f"silverlode {args.command}"))
    spark.sparkContext.setLogLevel("ERROR")
    try:
        print(execute(spark, args))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
