"""Bronze to clean layer, dead letters, aggregates and run metrics: the only code that starts jobs."""

from __future__ import annotations

import datetime
import re
import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.contract import (
    CRITICAL_COLUMNS,
    DEDUP_KEYS,
    FILL_DEFAULTS,
    Contract,
    Severity,
)
from silverlode.functions.predicates import any_of, count_where
from silverlode.functions.rules import Rule, cleaning_rules, contract_rules
from silverlode.functions.scalars import hashed, ntz
from silverlode.operators.dedup import dedup
from silverlode.operators.gold import daily_revenue_by_zone
from silverlode.operators.monitor import MAX_FAILURE, MAX_MINUTES, band_of
from silverlode.operators.privacy import PiiClass, sealed, unsealed
from silverlode.operators.route import ERROR_TYPE, FAILED_AT, Routed, reprocess, route
from silverlode.operators.validate import require_columns
from silverlode.session import delete_path, hide, scratch_path
from silverlode.sinks.writers import (
    with_dead_letter_folders,
    with_year_month,
    write_dead_letters,
    write_parquet,
)

METRICS_SCHEMA = (
    "run_ts timestamp_ntz, delivery string, status string, input_rows bigint, duplicate_rows bigint, "
    "schema_mismatch_rows bigint, type_error_rows bigint, missing_critical_rows bigint, "
    "business_rule_rows bigint, indeterminate_rows bigint, dlq_rows bigint, silver_rows bigint, "
    "warning_rows bigint, failure_rate double, band string, alert boolean, runtime_minutes double"
)

DELIVERY = "delivery"
DEAD_LETTER_FOLDERS = ("year", "month", "day", "run")
#: The delivery of a table that always comes as a whole.
WHOLE = "whole"


class FailureRateExceeded(RuntimeError):
    """Too many rows failed for the clean layer to be trusted."""


@dataclass(frozen=True)
class Layers:
    """Where a run writes. Paths without a value are not written."""

    silver: str
    dead_letters: str
    gold: str | None = None
    metrics: str | None = None


def run_timestamp() -> str:
    """The clock reading of a run, in UTC; taken once and passed everywhere."""
    now = datetime.datetime.now(datetime.timezone.utc)
    return now.strftime("%Y-%m-%d %H:%M:%S")


def read_layer(spark: SparkSession, path: str) -> DataFrame | None:
    """A layer with its delivery as text; None if nothing has been written there, or no row."""
    try:
        schema = spark.read.parquet(path).schema
    except AnalysisException as refused:
        if refused.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    fields = [T.StructField(f.name, T.StringType()) if f.name == DELIVERY else f for f in schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def delivery_path(layer: str, delivery: str) -> str:
    """The folder of one delivery in a layer."""
    if not re.fullmatch(r"[\w.+~-]+", delivery):
        raise ValueError(f"a delivery is named by letters, digits and . + ~ - _, got {delivery!r}")
    return f"{layer}/{DELIVERY}={delivery}"


def governing_rules(
    bronze: DataFrame,
    rules: Sequence[Rule],
    contract: Contract | None = None,
    zones: DataFrame | None = None,
    zone_columns: Sequence[str] = ("PULocationID", "DOLocationID"),
) -> tuple[DataFrame, list[Rule], list[str]]:
    """Rows with helper columns, all rules that decide a run, and the helper columns' names.

    To the cleaning rules come those of the contract, a name counting once, and for each zone column
    that its key is known. ``zones`` has the keys in its first column; its size is small and known when
    it has been written.
    """
    rules, helpers = list(rules), []
    if contract:
        named = {r.name for r in rules}
        rules += [r for r in contract_rules(contract) if r.name not in named]
    for column in zone_columns if zones is not None else ():
        known, helper = zones.select(F.col(zones.columns[0]).alias("_known")).distinct(), f"_unknown_{column}"
        bronze = bronze.join(known, F.col(column) == F.col("_known"), "left")
        unknown = F.col(column).isNotNull() & F.col("_known").isNull()
        bronze = bronze.withColumn(helper, unknown).drop("_known")
        rules.append(Rule(f"{column}_unknown", F.col(helper)))
        helpers.append(helper)
    return bronze, rules, helpers


def stage(
    spark: SparkSession, routed: Routed, path: str, warnings: Sequence[Rule] = ()
) -> tuple[Routed, dict]:
    """Write the routed rows once and read them back.

    The clean and the dead-letter layer are then two cheap reads of one result instead of two runs of
    the deduplication, and a lost executor costs no recomputation. Folders by verdict let each reader
    open only its own files. The metrics are observed by the tasks that write, so a row is counted
    once even if an earlier stage has to run again.
    """
    observed = Observation("routed")
    accepted = F.col(ERROR_TYPE).isNull()
    counts = {
        **routed.step_counts(),
        "warning_rows": count_where(accepted & any_of(r.violated for r in warnings)),
    }
    rows = routed.rows.observe(observed, *[c.alias(n) for n, c in counts.items()])
    layer = F.when(accepted, "silver").otherwise("dead_letters")
    rows.withColumn("_layer", layer).write.option("compression", "zstd").partitionBy("_layer").parquet(path)
    schema = routed.rows.withColumn("_layer", layer).schema
    staged = spark.read.schema(schema).parquet(path)
    return Routed(staged, routed.run_ts), observed.get


def _layer(routed: Routed, name: str) -> Routed:
    return Routed(routed.rows.where(F.col("_layer") == name).drop("_layer"), routed.run_ts)


def run(
    spark: SparkSession,
    bronze: DataFrame,
    layers: Layers,
    run_ts: str | None = None,
    delivery: str = WHOLE,
    keys: Sequence[str] = DEDUP_KEYS,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    fills: dict | None = None,
    rules: Sequence[Rule] | None = None,
    policy: dict[str, PiiClass] | None = None,
    salt: str | None = None,
    on_null: str = "quarantine",
    validate_first: bool = False,
    contract: Contract | None = None,
    zones: DataFrame | None = None,
    halt_above: float | None = None,
) -> dict:
    """Route ``bronze`` into the layers and return the metrics of the run.

    A run replaces what an earlier one wrote for the same ``delivery``, whatever months its rows fall
    in, and nothing of any other; aggregates are rebuilt for the months that held or hold a row of it.
    Dead letters are written before the clean layer, so a failure in between loses no rejected row.

    With a ``contract`` a delivery that lacks one of its columns is refused before anything is read,
    its critical rules decide rows as the cleaning rules do, and rows that only earn a warning are
    counted. ``zones`` does the same for unknown zone keys. If more than ``halt_above`` percent of the
    rows fail, only the dead letters and the row of the history are written and the run stops.

    A ``policy`` holds for the dead letters too; the original text of rows that could not be read is
    encrypted with the salt, or left out without one. Plans and logs don't show the salt.
    """
    started = time.monotonic()
    if contract:
        require_columns(bronze, contract)
    run_ts = run_ts or run_timestamp()
    silver_path, letters_path = (delivery_path(x, delivery) for x in (layers.silver, layers.dead_letters))
    rules = cleaning_rules(run_ts) if rules is None else rules
    bronze, rules, helpers = governing_rules(bronze, rules, contract, zones)
    routed = route(
        bronze,
        keys,
        critical,
        FILL_DEFAULTS if fills is None else fills,
        rules,
        run_ts,
        on_null=on_null,
        validate_first=validate_first,
    )
    routed = Routed(routed.rows.drop(*helpers), run_ts)
    path, show = scratch_path(spark, "routed"), hide(spark, salt)
    try:
        staged, counts = stage(spark, routed, path, [r for r in rules if r.severity is Severity.WARNING])
        letters = sealed(_layer(staged, "dead_letters").dead_letters, policy or {}, salt)
        # Rows that bring no time of failure all fail now, and their folder's columns are constants.
        write_dead_letters(letters, letters_path, by_run=True, sized=FAILED_AT in staged.rows.columns)
        total = counts["input_rows"]
        failure_rate = counts["dlq_rows"] * 100.0 / total if total else 0.0
        halted = halt_above is not None and failure_rate > halt_above
        if not halted:
            silver = _layer(staged, "silver").silver
            silver = with_year_month(sealed(silver, policy or {}, salt), "tpep_pickup_datetime")
            months = set(months_in(read_layer(spark, silver_path))) if layers.gold else set()
            write_parquet(silver, silver_path, partition_by=("year", "month"))
            if layers.gold:
                months |= set(months_in(spark.read.schema(silver.schema).parquet(silver_path)))
                rebuild_gold(spark, layers.silver, layers.gold, sorted(months))
    finally:
        show()
        delete_path(spark, path)

    metrics = {
        "run_ts": datetime.datetime.fromisoformat(run_ts),
        "delivery": delivery,
        "status": "halted" if halted else "done",
        **counts,
        "failure_rate": failure_rate,
        "band": band_of(failure_rate),
        "alert": failure_rate > MAX_FAILURE or (time.monotonic() - started) / 60.0 > MAX_MINUTES,
        "runtime_minutes": (time.monotonic() - started) / 60.0,
    }
    if layers.metrics:
        append_metrics(spark, metrics, layers.metrics)
    if halted:
        raise FailureRateExceeded(
            f"{failure_rate:.2f} % of {total} rows failed, more than {halt_above} %; "
            f"the dead letters are in {letters_path}, the clean layer is as it was"
        )
    return metrics


def reprocess_dead_letters(
    spark: SparkSession,
    layers: Layers,
    run_ts: str,
    rules: Sequence[Rule],
    critical: Sequence[str] = CRITICAL_COLUMNS,
    fills: dict | None = None,
    policy: dict[str, PiiClass] | None = None,
    salt: str | None = None,
    keys: Sequence[str] = DEDUP_KEYS,
    types: dict[str, str] | None = None,
    delimiter: str = ",",
) -> dict:
    """Move dead letters that pass the given rules to the clean layer and keep the others.

    With ``types`` rows that could not be read are read again from their text. Recovered rows go to
    their own delivery, unless a row with the same ``keys`` is there already: so a second run after one
    that broke off adds nothing twice, and neither does a trip that came in two deliveries. Aggregates
    and history follow. The dead letters are replaced last; until then they are all where they were.
    With a ``policy`` the dead letters hold no raw ids; their text is read with the ``salt``.
    """
    started = time.monotonic()
    letters = read_layer(spark, layers.dead_letters)
    if letters is None:
        return {"recovered_rows": 0, "added_rows": 0, "dlq_rows": 0}
    folders = [DELIVERY, *DEAD_LETTER_FOLDERS]
    before = letter_folders(letters)
    letters = letters.drop(*DEAD_LETTER_FOLDERS)
    if policy and salt:
        letters = unsealed(letters, salt)
    routed = reprocess(
        letters,
        critical,
        FILL_DEFAULTS if fills is None else fills,
        rules,
        run_ts,
        types=types,
        delimiter=delimiter,
    )
    path, fresh_path, show = scratch_path(spark, "routed"), scratch_path(spark, "fresh"), hide(spark, salt)
    try:
        staged, counts = stage(spark, routed, path)
        recovered = _layer(staged, "silver").silver
        recovered = with_year_month(sealed(recovered, policy or {}, salt), "tpep_pickup_datetime")
        months = months_in(recovered)
        fresh = _not_yet_there(recovered, read_layer(spark, layers.silver), keys, months)
        fresh.write.option("compression", "zstd").parquet(fresh_path)  # the clean layer is read here, so it is not yet written
        fresh = spark.read.schema(fresh.schema).parquet(fresh_path)
        added = fresh.count()
        write_parquet(fresh, layers.silver, mode="append", partition_by=(DELIVERY, "year", "month"))
        if layers.gold:
            rebuild_gold(spark, layers.silver, layers.gold, months)
        rest = sealed(_layer(staged, "dead_letters").dead_letters, policy or {}, salt)
        write_dead_letters(
            rest, layers.dead_letters, by_run=True, first=(DELIVERY,), folder=only_folder(before), dynamic=True
        )
        left = rest.select(DELIVERY, FAILED_AT)
        left = {tuple(r) for r in with_dead_letter_folders(left, FAILED_AT).select(*folders).distinct().collect()}
        for gone in sorted(before - left):
            folder = "/".join(f"{name}={value}" for name, value in zip(folders, gone, strict=True))
            delete_path(spark, f"{layers.dead_letters}/{folder}")
    finally:
        show()
        delete_path(spark, path)
        delete_path(spark, fresh_path)
    found = {"recovered_rows": counts["silver_rows"], "added_rows": added, "dlq_rows": counts["dlq_rows"]}
    if layers.metrics:
        rate = counts["dlq_rows"] * 100.0 / counts["input_rows"] if counts["input_rows"] else 0.0
        metrics = {
            "run_ts": datetime.datetime.fromisoformat(run_ts),
            "status": "reprocessed",
            **counts,
            "failure_rate": rate,
            "runtime_minutes": (time.monotonic() - started) / 60.0,
        }
        append_metrics(spark, metrics, layers.metrics)
    return found


def letter_folders(letters: DataFrame) -> set[tuple]:
    """The folders of dead letters: one per run and delivery."""
    return {tuple(r) for r in letters.select(DELIVERY, *DEAD_LETTER_FOLDERS).distinct().collect()}


def only_folder(folders: set[tuple]) -> dict | None:
    """The values of the folder columns if all letters lie in one folder."""
    if len(folders) != 1 or None in next(iter(folders)):
        return None
    return dict(zip((DELIVERY, *DEAD_LETTER_FOLDERS), *folders, strict=True))


def _not_yet_there(
    rows: DataFrame, silver: DataFrame | None, keys: Sequence[str], months: Sequence[tuple[int, int]]
) -> DataFrame:
    """One row per key, without the keys that the clean layer holds in these months."""
    rows = dedup(rows, keys).drop("_copies")
    if silver is None:
        return rows
    there = in_months(silver, months).select(*[F.col(k).alias(f"_there_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_there_{k}")) for k in keys]
    return rows.join(there, same, "left_anti")


def in_months(df: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of the given months; the condition is on the folders."""
    return df.where((F.col("year") * 12 + F.col("month")).isin([y * 12 + m for y, m in months]))


def months_in(silver: DataFrame | None) -> list[tuple[int, int]]:
    """The months a frame with year and month holds; as many rows as the calendar has months."""
    if silver is None:
        return []
    rows = silver.select("year", "month").distinct().collect()
    return sorted((r.year, r.month) for r in rows)


def rebuild_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    months: Sequence[tuple[int, int]] | None = None,
) -> None:
    """Aggregates of the clean layer, by month; they hold no row-level data.

    With ``months`` only those are read and replaced, and a month without a row any more goes.
    """
    silver = read_layer(spark, silver_path)
    if silver is not None:
        if months is not None:
            silver = in_months(silver, months)
        gold = daily_revenue_by_zone(silver, "tpep_pickup_datetime", "PULocationID", "total_amount")
        write_parquet(
            with_year_month(gold, "day"),
            gold_path,
            partition_by=("year", "month"),
            dynamic=months is not None,
        )
    for year, month in sorted(set(months or ()) - set(months_in(silver))):
        delete_path(spark, f"{gold_path}/year={year}/month={month}")


def erase_from_layers(
    spark: SparkSession, layers: Layers, subjects: DataFrame, key: str, salt: str | None = None
) -> dict[str, int]:
    """Rewrite the folders of the clean layer and the dead letters that hold rows of the given subjects.

    ``subjects`` has raw ids in its first column. ``key`` is the column with them; a layer that holds it
    hashed, as ``<key>_hashed``, is compared by the hash with the given salt. Only folders with a hit
    are read in full and replaced; the aggregates of their months are rebuilt. Returns the rows that
    went, by layer. A lake in published versions finds the folders by an index (`plans.lake`).
    """
    folders = {layers.silver: (DELIVERY, "year", "month"), layers.dead_letters: (DELIVERY, *DEAD_LETTER_FOLDERS)}
    gone, months = {}, set()
    for name, path in (("silver", layers.silver), ("dead_letters", layers.dead_letters)):
        gone[name], touched = _erase_from(spark, path, folders[path], subjects, key, salt)
        if name == "silver":
            months = {(int(t["year"]), int(t["month"])) for t in touched}
    if layers.gold and months:
        rebuild_gold(spark, layers.silver, layers.gold, sorted(months))
    return gone


def _erase_from(
    spark: SparkSession, path: str, parts: Sequence[str], subjects: DataFrame, key: str, salt: str | None
) -> tuple[int, list[dict]]:
    """Rows that went from one layer, and the folders that held them."""
    rows = read_layer(spark, path)
    if rows is None:
        return 0, []
    raw = F.col(subjects.columns[0]).cast("string")
    known = f"{key}_hashed"
    whose = F.col(known) if known in rows.columns else F.col(key).cast("string")
    wanted = subjects.select((hashed(raw, salt) if known in rows.columns else raw).alias("_subject")).distinct()
    hits = rows.join(wanted, whose == F.col("_subject"), "left_semi")
    touched = [r.asDict() for r in hits.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).collect()]  # a row per folder
    scratch = scratch_path(spark, "erased")
    try:
        for delivery in sorted({t[DELIVERY] for t in touched}):
            own = [t for t in touched if t[DELIVERY] == delivery]
            here = any_of(reduce(and_, [F.col(p) == t[p] for p in parts]) for t in own)
            kept = rows.where(here).join(wanted, whose == F.col("_subject"), "left_anti")
            kept.write.parquet(f"{scratch}/{delivery}")  # what is read can't be overwritten in place
            rest = spark.read.schema(kept.schema).parquet(f"{scratch}/{delivery}")
            left = {tuple(r) for r in rest.select(*parts).distinct().collect()}
            write_parquet(rest, path, partition_by=parts, dynamic=True)
            for t in own:
                if tuple(t[p] for p in parts) not in left:
                    delete_path(spark, "/".join([path, *[f"{p}={t[p]}" for p in parts]]))
    finally:
        if touched:
            delete_path(spark, scratch)
    return sum(t["n"] for t in touched), touched


def append_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """Add one row to the run history; what a run doesn't know is NULL."""
    names = [f.strip().split(" ")[0] for f in METRICS_SCHEMA.split(",")]
    row = spark.createDataFrame([{n: metrics.get(n) for n in names}], METRICS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def expire_before(df: DataFrame, column: str, as_of: str, keep_days: int) -> DataFrame:
    """The rows a retention rule lets stay."""
    limit = F.date_sub(ntz(as_of).cast("date"), keep_days)
    return df.where(F.col(column).isNull() | (F.to_date(column) >= limit))
