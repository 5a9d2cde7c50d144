"""Frames that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.contract import CRITICAL_COLUMNS, DEDUP_KEYS, FILL_DEFAULTS, TRIP_CONTRACT
from silverlode.functions.rules import cleaning_rules
from silverlode.operators.route import Routed, route
from silverlode.plans.trips import AS_OF, TRIP_COLUMNS, load, trips

__all__ = ["load", "trips", "routed_trips", "text_trips", "dates_as_text", "TRIP_TYPES"]

TRIP_TYPES = {**TRIP_CONTRACT.restricted_to(list(TRIP_COLUMNS)).types(), "trip_id": "bigint"}


def routed_trips(spark: SparkSession, sf_dir: str, **options) -> Routed:
    return route(
        trips(spark, sf_dir),
        DEDUP_KEYS,
        CRITICAL_COLUMNS,
        FILL_DEFAULTS,
        cleaning_rules(AS_OF),
        AS_OF,
        **options,
    )


def text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as they come from a text file: all columns are strings, some of them unreadable.

    Rows with the flag X have a payment type of '?', those of zone 25 a passenger count of 'many'.
    """
    df = trips(spark, sf_dir)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return text.withColumns(
        {
            "payment_type": F.when(F.col("store_and_fwd_flag") == "X", "?").otherwise(
                F.col("payment_type")
            ),
            "passenger_count": F.when(F.col("PULocationID") == "25", "many").otherwise(
                F.col("passenger_count")
            ),
        }
    )


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, the form in which results are compared."""
    return df.select(
        *[F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes]
    )
