"""Dimensions with history: which values a member had from when to when.

Every delivery is the whole dimension as of its day. A member's interval begins with the delivery that
shows a value first and ends, open at the end, with the first delivery that shows another one or no
such member. Intervals of a member never overlap, and together cover the days it was there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def validity(deliveries: DataFrame, key: str, columns: Sequence[str], day: str) -> DataFrame:
    """Intervals from all deliveries at once: key, columns, valid_from, valid_to (NULL for current ones).

    Rows that are equal count once, so a delivery that came twice changes nothing. Only the calendar of
    deliveries, one row per day, is ranked as a whole.
    """
    shown = deliveries.select(key, *columns, day).distinct()
    calendar = shown.select(F.col(day).alias("_day")).distinct()
    following = F.lead("_day").over(W.orderBy("_day"))
    calendar = calendar.withColumn("_until", following)
    own = W.partitionBy(key).orderBy(day)
    values = F.struct(*columns)
    placed = shown.join(calendar, F.col(day) == F.col("_day")).drop("_day").withColumn("_values", values)
    goes_on = F.lag("_values").over(own).eqNullSafe(F.col("_values")) & F.lag("_until").over(own).eqNullSafe(F.col(day))
    starts = placed.withColumn("_starts", F.when(goes_on, 0).otherwise(1))
    runs = starts.withColumn("_run", F.sum("_starts").over(own.rowsBetween(W.unboundedPreceding, 0)))
    # An interval that reaches the last delivery has no end: max passes over its NULL.
    open_end = F.max(F.col("_until").isNull())
    return runs.groupBy(key, "_run", *columns).agg(
        F.min(day).alias("valid_from"), F.when(~open_end, F.max("_until")).alias("valid_to")
    ).drop("_run")


def merge_delivery(history: DataFrame, members: DataFrame, key: str, columns: Sequence[str], as_of: str) -> DataFrame:
    """History after one more delivery as of a day: changed and missing members are closed, new values opened.

    The same delivery again changes nothing. ``members`` has one row per key.
    """
    day = F.lit(as_of).cast(history.schema["valid_from"].dataType)
    closed = history.where(F.col("valid_to").isNotNull())
    current = history.where(F.col("valid_to").isNull()).withColumn("_old", F.struct(*columns))
    new = members.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    both = current.join(new, F.col(key) == F.col("_key"), "full")
    same = F.col("_old").eqNullSafe(F.col("_new"))
    old_row = F.struct(F.col(key), F.col("_old"), F.col("valid_from"), F.when(~same, day).alias("valid_to"))
    new_row = F.struct(F.col("_key").alias(key), F.col("_new").alias("_old"), day.alias("valid_from"), F.lit(None).cast(day_type(history)).alias("valid_to"))
    rows = F.array_compact(
        F.array(F.when(F.col("_old").isNotNull(), old_row), F.when(F.col("_new").isNotNull() & ~same, new_row))
    )
    merged = both.select(F.explode(rows).alias("_row")).select("_row.*").select(key, "_old.*", "valid_from", "valid_to")
    # A value that was opened and closed by one day's deliveries held for no day.
    held = merged.where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    return closed.select(key, *columns, "valid_from", "valid_to").unionByName(held)


def day_type(history: DataFrame) -> str:
    return history.schema["valid_from"].dataType.simpleString()
