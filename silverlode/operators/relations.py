"""Joins between facts and dimensions.

No side carries a broadcast hint. Spark compares its size with ``autoBroadcastJoinThreshold`` at plan
time and again with real sizes under AQE; beyond that it shuffles and AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.predicates import count_where
from silverlode.functions.scalars import hashed


def orphan_rows(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose key is set but absent from the dimension."""
    known = dim.select(F.col(dim_key).alias("_known"))
    return fact.where(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_known"), "left_anti"
    )


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Orphaned keys with their row counts; facts are grouped first, so only keys meet the dimension."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return orphan_rows(counts, key, dim, dim_key)


def reference_report(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows with a known key, an unknown key and no key at all."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("_known")).distinct()
    joined = counts.join(known, F.col(key) == F.col("_known"), "left")
    state = (
        F.when(F.col(key).isNull(), "null_key")
        .when(F.col("_known").isNull(), "orphan")
        .otherwise("matched")
    )
    return joined.groupBy(state.alias("state")).agg(F.sum("n").alias("n"))


def enrich(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, columns: dict) -> DataFrame:
    """Add dimension columns (``{new name: dimension column}``) to every fact row.

    A key that the dimension holds more than once counts once, with the least of its rows, so facts
    are never multiplied.
    """
    values = F.struct(*[F.col(c).alias(new) for new, c in columns.items()])
    # The second key adds nothing but an exchange between grouping and join: only what comes straight
    # from one can be sent twice, which is how a hot key of the facts is split.
    own = F.col(dim_key)
    side = dim.groupBy(own.alias("_dim_key"), F.xxhash64(own).alias("_apart")).agg(F.min(values).alias("_dim"))
    joined = fact.join(side, F.col(key) == F.col("_dim_key"), "left")
    added = [F.col("_dim").getField(new).alias(new) for new in columns]
    return joined.select(*[F.col(c) for c in fact.columns], *added)


def absent_members(dim: DataFrame, dim_key: str, fact: DataFrame, key: str) -> DataFrame:
    """Dimension members that no fact row mentions; fact keys are made distinct before they travel."""
    seen = fact.where(F.col(key).isNotNull()).select(F.col(key).alias("_seen")).distinct()
    return dim.join(seen, F.col(dim_key) == F.col("_seen"), "left_anti")


def surrogate_key(column: str):
    """Key derived from the natural key, so that facts can compute it without a join."""
    return hashed(column)


def build_dimension(df: DataFrame, natural_key: str, name: str, attributes: dict) -> DataFrame:
    """Distinct members with a surrogate key; ``attributes`` maps new names to aggregate columns."""
    grouped = df.where(F.col(natural_key).isNotNull()).groupBy(natural_key)
    members = grouped.agg(*[e.alias(a) for a, e in attributes.items()]) if attributes else (
        grouped.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    )
    return members.select(
        surrogate_key(natural_key).alias(f"{name}_key"),
        F.col(natural_key).alias(f"{name}_id"),
        *attributes,
    )


def build_fact(df: DataFrame, links: dict[str, tuple[str, DataFrame]], measures: list) -> DataFrame:
    """Facts with one surrogate key per link; a natural key without a member gives NULL.

    ``links`` maps a column of ``df`` to (name of the link, dimension from ``build_dimension``). The key
    is computed from the fact; the dimension only says whether the member exists. Pass dimensions that
    have been written: then Spark knows their size, sends small ones to the facts and leaves these
    where they are.
    """
    for column, (name, dim) in links.items():
        dim_name = dim.columns[0].removesuffix("_key")
        members = dim.select(F.col(f"{dim_name}_id").alias("_id")).distinct()
        df = df.join(members, F.col(column) == F.col("_id"), "left")
        df = df.withColumn(f"{name}_key", F.when(F.col("_id").isNotNull(), surrogate_key(column))).drop("_id")
    return df.select(*[f"{name}_key" for name, _ in links.values()], *measures)


def reconcile(detail: DataFrame, rollup: DataFrame, count_column: str) -> DataFrame:
    """Row count of a layer against the sum of the counts in its aggregate."""
    zero = F.lit(0).cast("bigint")
    left = detail.agg(F.count(F.lit(1)).alias("_detail")).withColumn("_rollup", zero)
    right = rollup.agg(F.coalesce(F.sum(count_column), zero).alias("_rollup")).withColumn(
        "_detail", zero
    )
    both = left.unionByName(right).agg(
        F.sum("_detail").alias("detail_rows"), F.sum("_rollup").alias("rollup_rows")
    )
    return both.withColumn("passed", F.col("detail_rows") == F.col("rollup_rows"))


def completeness(dim: DataFrame, dim_key: str, fact: DataFrame, key: str) -> DataFrame:
    """How many expected members occur, and how many do not."""
    seen = fact.where(F.col(key).isNotNull()).select(F.col(key).alias("_seen")).distinct()
    joined = dim.join(seen, F.col(dim_key) == F.col("_seen"), "left")
    return joined.agg(
        F.count(F.lit(1)).alias("expected"),
        count_where(F.col("_seen").isNotNull()).alias("present"),
        count_where(F.col("_seen").isNull()).alias("absent"),
    )


#: Bits that keys are marked in, as a power of two: one megabyte, whatever the number of keys.
MARKS = 23


def perhaps_among(value: Column, keys: DataFrame) -> Column:
    """False for values that are certainly not among the keys in the first column, true for all that are.

    Each key marks a bit at its hash. With up to a million keys or so few other values find a marked bit, so
    a large side needs to be dealt for a join only where this is true; with very many keys it is true for
    most values. It decides what travels and never a result.
    """

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << MARKS))

    bit = F.expr("shiftleft(1L, CAST(_place & 63 AS INT))")
    marked = keys.select(place(F.col(keys.columns[0])).alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    every = keys.sparkSession.range(1 << (MARKS - 6)).join(marked, F.col("id") == F.col("_word"), "left")
    word = F.struct("id", F.coalesce("_bits", F.lit(0)).alias("bits"))
    words = every.agg(F.transform(F.sort_array(F.collect_list(word)), lambda w: w["bits"])).scalar()
    here = place(value)
    return F.getbit(words[F.shiftright(here, 6).cast("int")], here.bitwiseAND(F.lit(63)).cast("int")) == 1


def without_keys(rows: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose value is not among the keys in the first column, NULL included, in two frames.

    Those of the first frame lie as they were read; only those of the second have been dealt for the join.
    """
    perhaps = perhaps_among(F.col(column), keys)
    there = keys.select(F.col(keys.columns[0]).alias("_key"))
    return rows.where(~perhaps), rows.where(perhaps).join(there, F.col(column) == F.col("_key"), "left_anti")
