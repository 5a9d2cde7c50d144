"""Routing: every input row ends in the clean layer, in the dead-letter layer or as a counted copy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.contract import ErrorType, Severity
from silverlode.functions.predicates import (
    any_null,
    any_of,
    count_where,
    holds,
    names_where,
    percent,
)
from silverlode.functions.rules import Rule
from silverlode.functions.scalars import ntz
from silverlode.operators.clean import (
    ORIGINAL,
    TYPE_ERRORS,
    normalize_checked,
    present_defaults,
)
from silverlode.operators.dedup import dedup
from silverlode.sources.readers import CORRUPT, LINE, SOURCE_FILE

COPIES = "_copies"
HAD_NULLS = "_had_nulls"
ERROR_TYPE = "_error_type"
ERROR_MESSAGE = "_error_message"
FAILED_AT = "_failed_at"
DEAD_LETTER_COLUMNS = (ERROR_TYPE, ERROR_MESSAGE, FAILED_AT, SOURCE_FILE, ORIGINAL)
READ_FAULTS = (CORRUPT, TYPE_ERRORS)


def _read_faults(df: DataFrame) -> list[tuple[str, Column, Column]]:
    """(verdict, condition, message) for faults the reader or the type check left on the rows."""
    faults = []
    if CORRUPT in df.columns:
        text = F.lit("row does not fit the schema")
        faults.append((ErrorType.SCHEMA_MISMATCH.value, F.col(CORRUPT).isNotNull(), text))
    if TYPE_ERRORS in df.columns:
        names = F.col(TYPE_ERRORS)
        faults.append((ErrorType.TYPE_ERROR.value, names != "", names))
    return faults


def judge(
    df: DataFrame,
    critical: Sequence[str],
    fills: dict,
    rules: Sequence[Rule],
    on_null: str = "quarantine",
) -> DataFrame:
    """Add the verdict of each row; narrow, no shuffle.

    Rows that could not be read come first, then NULL in a critical column; the other rows get their
    defaults and face the rules.
    A row that breaks no rule but leaves one undecided is held back (``on_null="quarantine"``) or
    accepted (``"pass"``). ``_error_type`` is NULL for accepted rows. Warnings are for counting; only
    critical rules decide.
    """
    if on_null not in ("quarantine", "pass"):
        raise ValueError(f"on_null must be 'quarantine' or 'pass', got {on_null!r}")
    rules = [r for r in rules if r.severity is Severity.CRITICAL]
    fills = present_defaults(df, fills)
    missing = any_null(critical)
    filled = df.select(
        *[
            F.when(missing, F.col(c)).otherwise(F.coalesce(F.col(c), F.lit(fills[c]))).alias(c)
            if c in fills
            else F.col(c)
            for c in df.columns
        ],
        missing.alias("_missing"),
        any_null(fills).alias(HAD_NULLS),
    )
    # Each condition is evaluated once; verdict and message only look at the outcomes.
    broken = {r.name: f"_rule_{i}" for i, r in enumerate(rules)}
    tested = filled.withColumns({broken[r.name]: r.condition for r in rules})
    decided = tested.withColumn("_violated", any_of(holds(F.col(c)) for c in broken.values()))
    violated = F.col("_violated")
    undecided = any_null(broken.values()) if on_null == "quarantine" else F.lit(False)
    # NULL names a rule only where no other rule is broken.
    named = names_where({n: F.coalesce(F.col(c), ~violated) for n, c in broken.items()})
    grounds = [
        *_read_faults(df),
        (
            ErrorType.MISSING_CRITICAL.value,
            F.col("_missing"),
            names_where({c: F.col(c).isNull() for c in critical}),
        ),
        (ErrorType.BUSINESS_RULE.value, violated, named),
        (ErrorType.INDETERMINATE.value, undecided, named),
    ]
    verdict = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition, _ in grounds])
    readable = [g for g in grounds if g[2] is not named]
    message = F.coalesce(
        *[F.when(condition, text) for _, condition, text in readable],
        F.when(violated | undecided, named),
    )
    judged = decided.withColumns({ERROR_TYPE: verdict, ERROR_MESSAGE: message})
    return judged.drop("_missing", "_violated", *broken.values())


def quality_score(had_nulls: Column, distance: Column, fare: Column) -> Column:
    """100, less 10 for filled values, 5 for a zero distance and 5 for a zero fare."""
    return (
        F.lit(100)
        - F.when(had_nulls, 10).otherwise(0)
        - F.when(distance == 0, 5).otherwise(0)
        - F.when(fare == 0, 5).otherwise(0)
    ).cast("int")


@dataclass(frozen=True)
class Routed:
    """A judged frame and the views on it."""

    rows: DataFrame
    run_ts: str

    @property
    def source_columns(self) -> list[str]:
        added = (COPIES, HAD_NULLS, *DEAD_LETTER_COLUMNS, *READ_FAULTS)
        return [c for c in self.rows.columns if c not in added]

    def _text(self, *names: str) -> Column:
        """The first of the named columns that holds a value, NULL if the frame has none of them."""
        known = [F.col(c) for c in names if c in self.rows.columns]
        return F.coalesce(*known, F.lit(None).cast("string"))

    @property
    def silver(self) -> DataFrame:
        score = quality_score(F.col(HAD_NULLS), F.col("trip_distance"), F.col("fare_amount"))
        return self.rows.where(F.col(ERROR_TYPE).isNull()).select(
            *self.source_columns,
            ntz(self.run_ts).alias("processing_timestamp"),
            score.alias("data_quality_score"),
        )

    @property
    def dead_letters(self) -> DataFrame:
        """Rejected rows; one that was rejected before keeps the time of its first failure."""
        now = ntz(self.run_ts)
        failed_at = F.coalesce(FAILED_AT, now) if FAILED_AT in self.rows.columns else now
        return self.rows.where(F.col(ERROR_TYPE).isNotNull()).select(
            *self.source_columns,
            ERROR_TYPE,
            ERROR_MESSAGE,
            failed_at.alias(FAILED_AT),
            self._text(SOURCE_FILE).alias(SOURCE_FILE),
            self._text(ORIGINAL, CORRUPT).alias(ORIGINAL),
        )

    def step_counts(self) -> dict[str, Column]:
        """One aggregate per step; copies are counted from the survivors, so no row is scanned twice."""
        error = F.col(ERROR_TYPE)
        surplus = F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0))
        return {
            "input_rows": F.coalesce(F.sum(COPIES), F.lit(0)),
            "duplicate_rows": surplus,
            "schema_mismatch_rows": count_where(error == ErrorType.SCHEMA_MISMATCH.value),
            "type_error_rows": count_where(error == ErrorType.TYPE_ERROR.value),
            "missing_critical_rows": count_where(error == ErrorType.MISSING_CRITICAL.value),
            "business_rule_rows": count_where(error == ErrorType.BUSINESS_RULE.value),
            "indeterminate_rows": count_where(error == ErrorType.INDETERMINATE.value),
            "dlq_rows": count_where(error.isNotNull()),
            "silver_rows": count_where(error.isNull()),
        }

    def metrics(self) -> DataFrame:
        """One row: rows at each step and the failure rate in percent of the input."""
        counts = self.rows.agg(*[c.alias(n) for n, c in self.step_counts().items()])
        return counts.withColumns(
            {
                "failure_rate": F.coalesce(
                    percent(F.col("dlq_rows"), F.col("input_rows")), F.lit(0.0)
                ),
                "run_ts": ntz(self.run_ts),
            }
        )

    def verdict_counts(self) -> DataFrame:
        """Rows per verdict, duplicates included; the counts add up to the input."""
        steps = self.step_counts()
        labels = {"duplicate": "duplicate_rows"}
        if CORRUPT in self.rows.columns:
            labels[ErrorType.SCHEMA_MISMATCH.value] = "schema_mismatch_rows"
        if TYPE_ERRORS in self.rows.columns:
            labels[ErrorType.TYPE_ERROR.value] = "type_error_rows"
        labels[ErrorType.MISSING_CRITICAL.value] = "missing_critical_rows"
        labels[ErrorType.BUSINESS_RULE.value] = "business_rule_rows"
        labels[ErrorType.INDETERMINATE.value] = "indeterminate_rows"
        labels["silver"] = "silver_rows"
        wide = self.rows.agg(*[steps[s].alias(label) for label, s in labels.items()])
        return wide.unpivot([], list(labels), "verdict", "n")


def route(
    df: DataFrame,
    keys: Sequence[str],
    critical: Sequence[str],
    fills: dict,
    rules: Sequence[Rule],
    run_ts: str,
    on_null: str = "quarantine",
    validate_first: bool = False,
) -> Routed:
    """Deduplicate and judge.

    With ``validate_first`` rows are judged before the shuffle and only accepted ones are
    deduplicated: fewer rows travel, and copies of bad rows stay visible in the dead-letter layer.

    Faults left by the reader are part of the key, so an unreadable row never replaces a readable one.
    """
    keys = [*keys, *[c for c in READ_FAULTS if c in df.columns]]
    if not validate_first:
        return Routed(judge(dedup(df, keys, copies=COPIES), critical, fills, rules, on_null), run_ts)
    judged = judge(df, critical, fills, rules, on_null)
    accepted = judged.where(F.col(ERROR_TYPE).isNull())
    rejected = judged.where(F.col(ERROR_TYPE).isNotNull()).withColumn(COPIES, F.lit(1).cast("bigint"))
    # Empty verdict columns are taken off before the shuffle and put back after it.
    lean = accepted.drop(ERROR_TYPE, ERROR_MESSAGE)
    kept = dedup(lean, keys, copies=COPIES).withColumns(
        {ERROR_TYPE: F.lit(None).cast("string"), ERROR_MESSAGE: F.lit(None).cast("string")}
    )
    return Routed(kept.unionByName(rejected), run_ts)


def _unreadable() -> Column:
    return F.col(ERROR_TYPE).isin(ErrorType.SCHEMA_MISMATCH.value, ErrorType.TYPE_ERROR.value)


def reprocess(
    dead_letters: DataFrame,
    critical: Sequence[str],
    fills: dict,
    rules: Sequence[Rule],
    run_ts: str,
    on_null: str = "quarantine",
    types: dict[str, str] | None = None,
    delimiter: str = ",",
) -> Routed:
    """Judge dead letters again under new rules; ``silver`` are the recovered rows.

    Dead letters were deduplicated when they were first routed, so this is narrow. Defaults had been
    filled in before a row failed a rule, so a recovered row scores as if it had come complete. Rows
    that could not be read keep their verdict, or with ``types`` are read again from their text.
    """
    letters = dead_letters.withColumn(COPIES, F.lit(1).cast("bigint"))
    kept = _judge_again(letters, critical, fills, rules, on_null, keep_unreadable=not types)
    if types:
        carry = [c for c in letters.columns if c not in types and c not in (ERROR_TYPE, ERROR_MESSAGE, ORIGINAL)]
        again = reread(letters, types, delimiter, carry)
        read_again = judge(again, critical, fills, rules, on_null)
        unread = letters.where(_unreadable() & _row_of_text(types, delimiter).isNull()).withColumn(HAD_NULLS, F.lit(False))
        readable = kept.where(F.col("_readable")).drop("_readable")
        kept = readable.unionByName(read_again, allowMissingColumns=True).unionByName(unread, allowMissingColumns=True)
    return Routed(kept, run_ts)


def _judge_again(letters, critical, fills, rules, on_null, keep_unreadable: bool) -> DataFrame:
    source = letters.withColumns(
        {
            "_was_type": F.when(_unreadable(), F.col(ERROR_TYPE)),
            "_was_message": F.col(ERROR_MESSAGE),
        }
    ).drop(ERROR_TYPE, ERROR_MESSAGE)
    judged = judge(source, critical, fills, rules, on_null)
    stays = F.col("_was_type").isNotNull()
    verdicts = judged.withColumns(
        {
            ERROR_MESSAGE: F.when(stays, F.col("_was_message")).otherwise(F.col(ERROR_MESSAGE)),
            ERROR_TYPE: F.coalesce("_was_type", ERROR_TYPE),
        }
    )
    if not keep_unreadable:
        verdicts = verdicts.withColumn("_readable", F.col("_was_type").isNull())
    return verdicts.drop("_was_type", "_was_message")


def _row_of_text(types: dict[str, str], delimiter: str) -> Column:
    """The columns of an unreadable row as text; NULL where its text has no such row.

    Text kept with its names is JSON; a bare line has the columns of ``types`` in that order.
    """
    fields = ", ".join(f"`{c}` string" for c in types)
    original = F.col(ORIGINAL)
    has_names = (F.col(ERROR_TYPE) == ErrorType.TYPE_ERROR.value) | F.get_json_object(original, f"$.{LINE}").isNotNull()
    return F.when(_unreadable() & has_names, F.from_json(original, fields)).when(
        F.col(ERROR_TYPE) == ErrorType.SCHEMA_MISMATCH.value,
        F.from_csv(original, F.lit(fields), {"sep": delimiter}),
    )


def reread(
    dead_letters: DataFrame, types: dict[str, str], delimiter: str = ",", carry: Sequence[str] = (SOURCE_FILE,)
) -> DataFrame:
    """Read unreadable rows again from their original text, under corrected types.

    Text kept by the type check, or by a reader that knows the file's header, is JSON and read by name. A
    bare line is delimited, and its columns are those of ``types`` in that order. The result has one column per type, those to carry along, and
    what the type check adds, and can be routed like any delivery.
    """
    text = dead_letters.select(_row_of_text(types, delimiter).alias("_row"), *carry).where(F.col("_row").isNotNull())
    return normalize_checked(text.select("_row.*", *carry), types)
