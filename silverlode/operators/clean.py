"""Narrow cleaning operators: every one is a single projection, none shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.predicates import any_null, count_where, names_where
from silverlode.functions.scalars import (
    duration_minutes,
    money,
    ntz,
    snake_name,
    speed_per_hour,
    to_utc,
)

TYPE_ERRORS = "_type_errors"
ORIGINAL = "_original_record"


# How text begins that Spark may read as the type. Text that begins otherwise cannot be read.
NUMBER_START = r"^[\s\p{Cntrl}]*[+-]?(\p{Nd}|\.\p{Nd}|(?i:inf|nan))"
TIME_START = r"^[\s\p{Cntrl}]*[+-]?[\dT]"
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
TIMES = ("date", "timestamp", "timestamp_ntz")


def read_as(df: DataFrame, column: str, data_type: str) -> Column:
    """The column as the type, NULL where it cannot be read.

    A failing cast raises and catches an exception inside Spark, some twenty times the cost of a cast
    that works. Text that cannot succeed is therefore not tried.
    """
    value = F.col(column)
    base = data_type.split("(")[0]
    if df.schema[column].dataType != T.StringType() or base not in NUMBERS + TIMES:
        return value.try_cast(data_type)
    start = NUMBER_START if base in NUMBERS else TIME_START
    return F.when(value.rlike(start), value.try_cast(data_type))


def normalize_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes NULL and is caught by the rules."""
    return df.select(
        *[read_as(df, c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def lost_in_cast(df: DataFrame, column: str, data_type: str) -> Column:
    """True where a value is present but cannot be read as the type."""
    return F.col(column).isNotNull() & read_as(df, column, data_type).isNull()


def flag_type_errors(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add the names of the columns whose value cannot be read as its type ('' for none)."""
    lost = {c: lost_in_cast(df, c, t) for c, t in types.items() if c in df.columns}
    return df.withColumn(TYPE_ERRORS, names_where(lost))


def normalize_checked(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast, and keep with each row that lost a value the names of its columns and its original text.

    Every value is cast once; the check compares what came in with what came out. What an earlier check
    found is kept: its columns come first, and its text of the row stays.
    """
    types = {c: t for c, t in types.items() if c in df.columns}
    found = [c for c in (TYPE_ERRORS, ORIGINAL) if c in df.columns]
    raw = {c: f"_raw_{i}" for i, c in enumerate(df.columns) if c not in found}
    both = df.select(
        *[F.col(c).alias(r) for c, r in raw.items()],
        *[read_as(df, c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns],
    )
    names = names_where({c: F.col(raw[c]).isNotNull() & F.col(c).isNull() for c in types})
    if TYPE_ERRORS in found:
        names = F.concat_ws(", ", F.nullif(TYPE_ERRORS, F.lit("")), F.nullif(names, F.lit("")))
    text = F.to_json(F.struct(*[F.col(r).alias(c) for c, r in raw.items()]))
    original = F.when(F.col(TYPE_ERRORS) != "", text)
    if ORIGINAL in found:
        original = F.coalesce(ORIGINAL, original)
    flagged = both.withColumn(TYPE_ERRORS, names).withColumn(ORIGINAL, original)
    return flagged.drop(*raw.values())


def add_run_columns(df: DataFrame, run_ts: str, batch: str) -> DataFrame:
    """Literal columns shared by a whole run; one clock reading per run, not per action."""
    return df.withColumns({"processing_timestamp": ntz(run_ts), "batch_id": F.lit(batch)})


def present_defaults(df: DataFrame, defaults: dict) -> dict:
    return {c: v for c, v in defaults.items() if c in df.columns}


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace NULL by a default in those of the named columns that exist."""
    present = present_defaults(df, defaults)
    return df.fillna(present) if present else df


def fill_counts(df: DataFrame, defaults: dict) -> DataFrame:
    """How many values a fill would replace, one row per column, in one pass."""
    present = present_defaults(df, defaults)
    counts = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in present])
    return counts.unpivot([], list(present), "column", "filled")


def flag_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mark rows with NULLs and say in which columns, instead of dropping or filling them."""
    return df.withColumns(
        {
            "_has_nulls": any_null(columns),
            "_null_columns": names_where({c: F.col(c).isNull() for c in columns}),
        }
    )


def trip_metrics(df: DataFrame) -> DataFrame:
    """Duration, speed and tip rate; NULL where a divisor is zero or an input is NULL."""
    return df.withColumns(
        {
            "duration_minutes": duration_minutes(
                "tpep_pickup_datetime", "tpep_dropoff_datetime"
            ),
            "speed_mph": speed_per_hour(
                "trip_distance", "tpep_pickup_datetime", "tpep_dropoff_datetime"
            ),
            "tip_rate": F.try_divide(F.col("tip_amount"), F.col("fare_amount")),
        }
    )


def snake_case(df: DataFrame) -> DataFrame:
    names = [snake_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"different columns would share a name: {clashes}")
    return df.toDF(*names)


def utc_columns(df: DataFrame, columns: Sequence[str], zone: str) -> DataFrame:
    """Turn local wall-clock columns into UTC, in place."""
    return df.withColumns({c: to_utc(c, zone) for c in columns})


def money_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: money(c) for c in columns})


def sample_rows(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a total order: a preview that is the same on every run. 0 gives none.

    Spark keeps only the best ``n`` rows per task and merges those, so nothing is sorted as a whole.
    """
    return df.orderBy(*(order or df.columns)).limit(n)
