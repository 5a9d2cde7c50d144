"""Run queries against their oracles on the same files."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, decimal.Decimal):
        return str(value)
    raise TypeError(f"compare only plain values, got {type(value)}")


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    """What differs between a frame and a SQL result: names, types or rows."""
    relation = connection.sql(sql)
    theirs = dict(zip(relation.columns, [str(t) for t in relation.types]))
    ours = dict(df.dtypes)
    if sorted(theirs) != sorted(ours):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    found = [
        f"type of {c}: {ours[c]} against {theirs[c]}"
        for c in sorted(ours)
        if KINDS.get(ours[c]) != theirs[c]
    ]
    order = sorted(ours)
    table = df.select(*[df[f"`{c}`"] for c in order]).toArrow()
    mine = Counter(
        tuple(normal(v) for v in row) for row in zip(*[c.to_pylist() for c in table.columns])
    )
    quoted = ", ".join(f'"{c}"' for c in order)
    want = Counter(
        tuple(normal(v) for v in row)
        for row in connection.sql(f"SELECT {quoted} FROM ({sql})").fetchall()
    )
    if mine != want:
        extra, lost = list((mine - want).items())[:2], list((want - mine).items())[:2]
        found.append(
            f"rows {sum(mine.values())} against {sum(want.values())}; only ours {extra}; only theirs {lost}"
        )
    return found
