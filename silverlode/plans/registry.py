"""Named queries and the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from silverlode.session import scratch_path

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFunction
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a function as a query under its own name."""

    def register(run: QueryFunction) -> QueryFunction:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = Query(key, run, oracle.strip() if oracle else None)
        return run

    return register


_written: dict[tuple[str, str, str], str] = {}


def written_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]
) -> str:
    """Path of a table written for this session and input; the first caller writes it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]
