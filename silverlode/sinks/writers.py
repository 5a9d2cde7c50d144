"""Writers for the clean, aggregate and dead-letter layers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.scalars import day_of
from silverlode.session import delete_path
from silverlode.sources.footers import file_list

CODECS = ("snappy", "gzip", "zstd", "none")


def sized_for(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, then let AQE cut them into files of good size.

    REBALANCE splits a partition value that is too large (a hot month) over several tasks and merges
    small ones, so neither tiny files nor one giant task result. The target is
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    return df.hint("rebalance", *partition_columns)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    codec: str = "snappy",
    dynamic: bool = False,
    sized: bool = True,
) -> None:
    """Write Parquet. ``dynamic`` replaces only the partitions present in ``df``."""
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, got {codec!r}")
    if dynamic and not partition_by:
        raise ValueError("dynamic overwrite needs partition columns")
    if partition_by and sized:
        df = sized_for(df, partition_by)
    writer = df.write.mode(mode).option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    (
        df.write.mode(mode)
        .option("header", str(header).lower())
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def parquet_to_csv(spark: SparkSession, source: str, target: str) -> None:
    write_csv(spark.read.parquet(source), target)


def with_year_month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns({"year": F.year(column), "month": F.month(column)})


def with_year_month_day(df: DataFrame, column: str) -> DataFrame:
    return with_year_month(df, column).withColumn("day", F.dayofmonth(column))


def write_by_month(df: DataFrame, path: str, column: str, **options) -> None:
    """Clean layer: one folder per year and month of ``column``."""
    write_parquet(with_year_month(df, column), path, partition_by=("year", "month"), **options)


def with_dead_letter_folders(df: DataFrame, column: str = "_failed_at") -> DataFrame:
    """Year, month, day and run of the time of failure."""
    run = F.translate(F.col(column).cast("string"), " -:", "_")
    return with_year_month_day(df, column).withColumn("run", run)


def write_dead_letters(
    df: DataFrame,
    path: str,
    column: str = "_failed_at",
    by_run: bool = False,
    first: Sequence[str] = (),
    folder: dict | None = None,
    **options,
) -> None:
    """Dead-letter layer: one folder per day of failure.

    ``by_run`` adds a folder per time of failure, so that two runs of one day do not replace each
    other's rows while a repeated run replaces its own. ``first`` names columns for folders above.
    ``folder`` has the values of all folder columns if the rows are known to belong to one folder: they
    are then written as they are read, and neither moved nor sorted.
    """
    partitions = [*first, "year", "month", "day", *(["run"] if by_run else [])]
    if folder is not None:
        df = df.withColumns({p: F.lit(folder[p]) for p in partitions})
        options = {**options, "sized": False}
    else:
        df = with_dead_letter_folders(df, column) if by_run else with_year_month_day(df, column)
    write_parquet(df, path, partition_by=partitions, **options)


def in_date_range(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows with ``first <= day <= last`` of a table partitioned by year and month.

    The condition on the year and month columns is implied by the one on ``column``; spelling it out
    is what lets the reader skip folders.
    """
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    month_number = F.col("year") * 12 + F.col("month")
    return df.where(
        F.col("year").between(F.year(start), F.year(end))
        & month_number.between(F.year(start) * 12 + F.month(start), F.year(end) * 12 + F.month(end))
        & (F.col(column) >= start.cast("timestamp_ntz"))
        & (F.col(column) < F.date_add(end, 1).cast("timestamp_ntz"))
    )


def drop_expired_days(
    spark: SparkSession, path: str, as_of: str, keep_days: int, dry_run: bool = True
) -> list[str]:
    """Retention on a table partitioned by year, month and day: the folders older than allowed.

    Files are listed and none is opened, one row per day; with ``dry_run=False`` the folders go.
    """
    day = F.make_date("year", "month", "day")
    expired = (
        file_list(spark, path)
        .select("year", "month", "day")
        .distinct()
        .where(day < F.date_sub(F.lit(as_of).cast("date"), keep_days))
        .orderBy("year", "month", "day")
    )
    folders = [f"{path}/year={r.year}/month={r.month}/day={r.day}" for r in expired.collect()]
    if not dry_run:
        for folder in folders:
            delete_path(spark, folder)
    return folders


def is_expired(column: str, as_of: str, keep_days: int):
    """Row-level retention test: the day lies more than ``keep_days`` days back."""
    return day_of(column) < F.date_sub(F.lit(as_of).cast("date"), keep_days)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame for several actions, spilling to disk, and let go of it afterwards."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
