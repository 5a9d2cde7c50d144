"""Mixing sources to target weights by systematic sampling.

Every source gets a target by its weight; within a source each document has the same expected
number of copies, target / size of the source. The expected copies are summed up along the
documents in order of size, one random offset is added, and a document is emitted once for each
integer that its stretch crosses. So the number of copies is the expected one rounded down or up,
and because neighbours have like sizes, a source's words miss its target by less than the words
of its largest document.

All sums are integers (copies count in units of 2 ** -32), so reruns agree. The running sum is
dealt out by ranges, so a source may hold any share of the rows.

Defined results: a null or blank text has size 0 and is never needed to reach a target, so it gets
copies like any other but counts no words; a null source is a source of its own, ordered last; a
source without words has target 0 and no copies; repeated rows are drawn one by one; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.tables import Kept, running_sum

WORD = r"[^\x20\x09-\x0D]+"
#: An expected copy in integer units.
UNIT = 1 << 32
MOST_COPIES = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _exact(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def targets(kept: Kept, sizes: DataFrame, weights: Sequence[int], most: int = MOST_COPIES) -> DataFrame:
    """Rows (source, source_size, target, expected): target words, and copies of a document in UNITs.

    sizes has source and size. Sources in code point order take the weights in turn and share all
    words by them; a target stops at most times its source's size, and what is left is shared
    again by weight until no target is above.
    """
    sources = kept.write(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    sources = sources.withColumn("last", F.col("source").isNull())
    sources = running_sum(kept, sources, [], ["last", "source"], F.lit(1).cast("decimal(20,0)"), "rank")
    turn = ((F.col("rank") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("decimal(38,0)")
    sources = kept.write(sources.select("source", "source_size", weight.alias("weight")), "weighted")
    size = F.col("source_size").cast("decimal(38,0)")
    level: Fraction | None = None  # words for a weight of one
    while True:
        if level is None:
            full = F.lit(False)
        else:
            full = F.col("weight") * _exact(level.numerator) > size * _exact(most * level.denominator)
        total, left, weights_left = sources.agg(
            F.sum(size), F.sum(F.when(full, -most * size).otherwise(0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not total or not weights_left:
            level = Fraction(0)
            break
        new = Fraction(int(total) + int(left), int(weights_left))
        if new == level:
            break
        level = new
    num, den = _exact(level.numerator), _exact(level.denominator)
    full = F.col("weight") * num > size * den * most
    share = F.expr(f"(weight * {level.numerator}BD * {UNIT}BD) div (CAST(source_size AS decimal(20,0)) * {level.denominator}BD)")
    return sources.select(
        "source",
        "source_size",
        F.when(full, (most * size).cast("double"))
        .otherwise((F.col("weight") * num).cast("double") / den.cast("double"))
        .alias("target"),
        F.when(F.col("source_size") == 0, 0).when(full, most * UNIT).otherwise(share).cast("long").alias("expected"),
    )


def offset(source: Column, seed: int) -> Column:
    """The source's random offset in [0, UNIT), from its name and the seed."""
    digest = F.md5(F.concat(F.coalesce(source, F.lit("")), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("decimal(20,0)")


def copies(
    kept: Kept, sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), seed: int = 42, id_column: str = "doc_id"
) -> DataFrame:
    """sizes (with source and size) with source_size, target and the number of copies."""
    shares = kept.write(targets(kept, sizes, weights), "targets").withColumnRenamed("source", "_source")
    rows = sizes.join(shares, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    expected = F.col("expected").cast("decimal(20,0)")
    rows = running_sum(kept, rows, ["source"], ["size", id_column], expected, "upto")
    start = offset(F.col("source"), seed)
    ends = rows.withColumn("_end", F.col("upto") + start).withColumn("_start", F.col("_end") - expected)
    made = F.expr(f"_end div {UNIT}BD - _start div {UNIT}BD")
    return ends.withColumn("copies", made.cast("long")).drop("upto", "expected", "_end", "_start")


def mixed(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), seed: int = 42) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken), one per document; taken counts its words in the mix."""
    kept = Kept()
    sizes = kept.write(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    rows = copies(kept, sizes, weights, seed)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)
