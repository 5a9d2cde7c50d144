"""Schemas as tables: listing, comparison and the class of a change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.predicates import count_where
from silverlode.operators.clean import lost_in_cast

BREAKING = "breaking"
NON_BREAKING = "non_breaking"
UNCHANGED = "unchanged"


def schema_frame(spark: SparkSession, types: dict[str, str]) -> DataFrame:
    """Columns as rows: ordinal, name, type."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(types.items())]
    return spark.createDataFrame(rows, "ordinal int, name string, type string")


def types_of(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def describe_schema(df: DataFrame) -> DataFrame:
    """Columns as rows with the number of values each holds."""
    listing = schema_frame(df.sparkSession, types_of(df.schema))
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot(
        [], df.columns, "_column", "n_values"
    )
    return listing.join(filled, F.col("name") == F.col("_column")).drop("_column")


def schema_diff(spark: SparkSession, old: dict[str, str], new: dict[str, str]) -> DataFrame:
    """Every column of either schema and what became of it. A rename shows as removed plus added."""
    a = schema_frame(spark, old).select(F.col("name").alias("_a"), F.col("type").alias("old_type"))
    b = schema_frame(spark, new).select(F.col("name").alias("_b"), F.col("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .otherwise("same")
    )
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(
        F.coalesce("_a", "_b").alias("column"), "old_type", "new_type", change.alias("change")
    )


def classify_changes(diff: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Removal and retyping break consumers; so does a new column that must not be NULL.

    ``required`` names the columns of the new schema that must hold a value.
    """
    must = F.col("column").isin(list(required))
    kind = (
        F.when(F.col("change").isin("removed", "retyped"), BREAKING)
        .when((F.col("change") == "added") & must, BREAKING)
        .when(F.col("change") == "added", NON_BREAKING)
        .otherwise(UNCHANGED)
    )
    return diff.withColumn("change_class", kind)


def schema_drift(df: DataFrame, expected: dict[str, str], required: Sequence[str] = ()) -> DataFrame:
    """The diff between what is expected and ``df``, with its weight in the data.

    ``n_values`` counts the values in the column as delivered; ``n_unreadable`` those that cannot be
    read as the expected type. All counts come from one pass. ``required`` names the columns that must
    hold a value, such as those a contract declares so: a new one among them breaks consumers.
    """
    actual = types_of(df.schema)
    names = list(dict.fromkeys([*expected, *actual]))
    counts = []
    for c in names:
        present = F.count(c) if c in actual else F.lit(0).cast("bigint")
        lost = (
            count_where(lost_in_cast(df, c, expected[c]))
            if c in actual and expected.get(c, actual[c]) != actual[c]
            else F.lit(0).cast("bigint")
        )
        counts.append(F.struct(F.lit(c).alias("_c"), present.alias("n_values"), lost.alias("n_unreadable")))
    weights = df.agg(F.array(*counts).alias("_w")).select(F.inline("_w"))
    diff = classify_changes(schema_diff(df.sparkSession, expected, actual), required)
    return diff.join(weights, F.col("column") == F.col("_c")).drop("_c")
