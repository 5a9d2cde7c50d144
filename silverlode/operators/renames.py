"""Columns that went and columns that came: which of them are one column under a new name.

A column is known by what it holds: its kind, its share of NULLs, its quantiles if it holds numbers or
times, and a MinHash of its distinct values (a theta sketch, which keeps the smallest hashes). One pass
over a table makes the profiles of all its columns; only these, a row per column, are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.schema import BREAKING, NON_BREAKING

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
#: Weights of equal values, of like quantiles and of like NULL shares; below ALIKE nothing is one column.
VALUES, SHAPE, NULLS, ALIKE = 0.4, 0.5, 0.1, 0.55


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "number"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    return "flag" if isinstance(data_type, T.BooleanType) else "text"


def _number(column: str, kind: str) -> Column | None:
    value = F.col(column)
    if kind == "time":
        return F.unix_seconds(value.cast("timestamp_ltz")).cast("double")
    return value.cast("double") if kind == "number" else None


def column_profiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: kind, n_values, null_share, quantiles and a sketch of its distinct values."""
    kinds = {c: kind_of(df.schema[c].dataType) for c in columns}
    parts = []
    for c in columns:
        number = _number(c, kinds[c])
        # 7 and 7.0 are one value.
        value = F.col(c).cast("string") if number is None else number.cast("string")
        cuts = F.lit(None).cast("array<double>") if number is None else F.approx_percentile(number, list(QUANTILES), 1000)
        parts += [F.count(c).alias(f"{c}__n"), cuts.alias(f"{c}__q"), F.theta_sketch_agg(value).alias(f"{c}__s")]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *parts)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kinds[c]).alias("kind"),
            F.col(f"{c}__n").alias("n_values"),
            F.coalesce(F.try_divide(F.col("__rows") - F.col(f"{c}__n"), F.col("__rows")), F.lit(0.0)).alias("null_share"),
            F.col(f"{c}__q").alias("quantiles"),
            F.col(f"{c}__s").alias("sketch"),
        )
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def likeness(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every old column against every new one of its kind: (old, new, score), a row per pair of columns."""
    a, b = (x.select(*[F.col(c).alias(f"{side}_{c}") for c in x.columns]) for side, x in (("old", old), ("new", new)))
    pairs = a.join(b, F.col("old_kind") == F.col("new_kind"))
    shared = F.theta_sketch_estimate(F.theta_intersection("old_sketch", "new_sketch"))
    every = F.theta_sketch_estimate(F.theta_union("old_sketch", "new_sketch"))
    values = F.coalesce(F.try_divide(shared.cast("double"), every.cast("double")), F.lit(0.0))
    spread = F.array_max(F.concat("old_quantiles", "new_quantiles")) - F.array_min(F.concat("old_quantiles", "new_quantiles"))
    gaps = F.aggregate(F.zip_with("old_quantiles", "new_quantiles", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
    apart = F.try_divide(gaps, F.lit(float(len(QUANTILES))) * spread)
    # Text has no quantiles: equal values speak for its shape too.
    shape = F.when(F.col("old_quantiles").isNull(), values).when(spread == 0, 1.0).otherwise(1.0 - F.coalesce(apart, F.lit(1.0)))
    nulls = 1.0 - F.abs(F.col("old_null_share") - F.col("new_null_share"))
    score = VALUES * values + SHAPE * shape + NULLS * nulls
    return pairs.select(F.col("old_column").alias("old"), F.col("new_column").alias("new"), score.alias("score"))


def assignment(scores: dict[tuple[str, str], float], least: float = ALIKE) -> dict[str, str]:
    """Pairs of old and new columns with the largest sum of scores, each column in one pair at most.

    Pairs below ``least`` are not made. Old columns are placed one by one along the cheapest chain of
    exchanges; prices of the columns keep each step's choice the best one overall.
    """
    olds, news = (sorted({p[side] for p in scores}) for side in (0, 1))
    size = max(len(olds), len(news))
    cost = [[0.0] * size for _ in range(size)]  # no pair costs nothing
    for (old, new), score in scores.items():
        if score >= least:
            cost[olds.index(old)][news.index(new)] = -score
    row_price, column_price = [0.0] * size, [0.0] * (size + 1)
    owner: list[int] = [-1] * (size + 1)  # of each column; the last one is where a search starts
    for row in range(size):
        owner[size], column = row, size
        slack, came_from, seen = [float("inf")] * size, [size] * size, set()
        while owner[column] >= 0:
            seen.add(column)
            here, open_columns = owner[column], [c for c in range(size) if c not in seen]
            for c in open_columns:
                gap = cost[here][c] - row_price[here] - column_price[c]
                if gap < slack[c]:
                    slack[c], came_from[c] = gap, column
            nearest = min(open_columns, key=lambda c: slack[c])
            step = slack[nearest]
            for c in seen:
                row_price[owner[c]] += step
                column_price[c] -= step
            for c in open_columns:
                slack[c] -= step
            column = nearest
        while column != size:
            owner[column] = owner[came_from[column]]
            column = came_from[column]
    pairs = {(olds[o], news[c]) for c, o in enumerate(owner[:size]) if o < len(olds) and c < len(news)}
    return {old: new for old, new in sorted(pairs) if scores.get((old, new), 0.0) >= least}


@dataclass(frozen=True)
class Change:
    change: str
    old: str | None
    new: str | None
    score: float | None
    change_class: str


def find_renames(before: DataFrame, after: DataFrame, required: Sequence[str] = ()) -> list[Change]:
    """Columns of ``before`` that ``after`` lacks, and new ones, with renames told apart.

    Removals and renames break consumers; so does a new column among ``required``, which must hold a
    value. Only the profiles of the changed columns reach the driver.
    """
    gone = [c for c in before.columns if c not in after.columns]
    came = [c for c in after.columns if c not in before.columns]
    scores = {}
    if gone and came:
        pairs = likeness(column_profiles(before, gone), column_profiles(after, came))
        scores = {(r.old, r.new): r.score for r in pairs.collect()}  # columns by columns
    renamed = assignment(scores)
    out = [Change("renamed", o, n, scores[o, n], BREAKING) for o, n in sorted(renamed.items())]
    out += [Change("removed", c, None, None, BREAKING) for c in gone if c not in renamed]
    new = [c for c in came if c not in renamed.values()]
    return out + [Change("added", None, c, None, BREAKING if c in required else NON_BREAKING) for c in new]


def as_frame(spark: SparkSession, changes: Sequence[Change]) -> DataFrame:
    schema = "change string, old string, new string, score double, change_class string"
    return spark.createDataFrame([(c.change, c.old, c.new, c.score, c.change_class) for c in changes], schema)


def new_codes(df: DataFrame, domains: dict[str, Sequence[str]]) -> DataFrame:
    """Codes that a column holds and its domain lacks, with their rows: a change that breaks nobody."""
    frames = [
        df.where(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*codes))
        .groupBy(F.col(c).cast("string").alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(c).alias("column"), "code", "n", F.lit(NON_BREAKING).alias("change_class"))
        for c, codes in domains.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
