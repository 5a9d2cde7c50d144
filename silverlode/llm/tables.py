"""Written intermediate tables, connected components and running sums as plain Spark jobs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from silverlode.session import delete_path, scratch_path


class Kept:
    """Tables written to the shared scratch folder, so that later jobs start from files.

    They go with the application, or earlier by drop().
    """

    def __init__(self) -> None:
        self.paths: list[tuple] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        self.paths.append((spark, path))
        return spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for spark, path in self.paths:
            delete_path(spark, path)
        self.paths.clear()


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name that none of the taken ones equals, whatever their case."""
    lowered = {t.lower() for t in taken}
    while wanted.lower() in lowered:
        wanted += "_"
    return wanted


def keyed(kept: Kept, docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with columns that tell its rows apart in every read, and their names.

    For a read of Parquet files these are file and row number; anything else is written down first.
    """
    file, row = free_name("_file", docs.columns), free_name("_row", docs.columns)
    if free_name("_metadata", docs.columns) == "_metadata":
        try:
            return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)), [file, row]
        except AnalysisException:
            pass  # not a plain read of files
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return kept.write(numbered, "numbered"), [row]


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b): root is the smallest node it reaches.

    Alternates two steps until nothing changes: every node sends its larger neighbours, then its
    smaller ones, to the smallest of its neighbourhood. Both are a sum by node and a join, so a
    node with very many neighbours is pre-aggregated before the shuffle. The sums are written before
    they are joined: read from files they are dealt anew, and the join can split a hot node.
    The nodes must be of a type that has an order; loops are allowed.
    """
    old = Kept()
    now = old.write(_pairs(edges.select("a", "b")), "edges")
    told = _state(now)
    while True:
        new = Kept()
        now = new.write(_small_star(new, _large_star(new, now)), "edges")
        old.drop()
        old = new
        before, told = told, _state(now)
        if before == told:
            break
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _pairs(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum of them."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(kept: Kept, edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min(F.least("a", "b")).alias("m"))
    larger = both.where("b > a").join(kept.write(least, "least"), F.col("a") == F.col("u"))
    return _pairs(larger.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(kept: Kept, edges: DataFrame) -> DataFrame:
    edges = kept.write(edges, "large")
    least = kept.write(edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "least")
    joined = edges.join(least, F.col("a") == F.col("u"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _pairs(moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))


def running_sum(
    kept: Kept,
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: Column,
    into: str,
    rows_each: int = 200_000,
) -> DataFrame:
    """df with the sum of value over the group's rows up to and with this one, in the given order.

    The rows are dealt to tasks by ranges of (group, order), so a group of any size is spread. A
    task sums its own rows; the sums of the ranges before it come from one row per range and group.
    Rows that are equal in group and order may change places. The value must be exact (long or
    decimal) for reruns to agree.
    """
    spark = df.sparkSession
    n = df.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // rows_each + 1)
    ranged = kept.write(
        df.withColumn("_value", value).repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    sums = ranged.groupBy(*group, "_part").agg(F.sum("_value").alias("_sum"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = kept.write(sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))), "offsets")
    sums = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), "_before")
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    own = W.partitionBy("_part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    summed = ranged.withColumn("_own", F.sum("_value").over(own))
    joined = summed.join(sums, [F.col("_part") == F.col("_p"), *same])
    return joined.withColumn(into, F.col("_before") + F.col("_own")).drop(
        "_value", "_part", "_own", "_before", "_p", *[f"_g{i}" for i in range(len(group))]
    )
