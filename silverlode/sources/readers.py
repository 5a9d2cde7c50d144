"""Readers for the raw layer. A path may be one file, a folder or a list of either, on any scheme."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.clean import ORIGINAL, normalize_checked

CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
#: The whole line among the values of a row that could not be read.
LINE = "_line"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")

Paths = str | Sequence[str]


def _as_list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def with_source_file(df: DataFrame) -> DataFrame:
    """Lineage column. Must be taken at the scan: after a shuffle the file is no longer known."""
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_parquet(
    spark: SparkSession, paths: Paths, merge_schema: bool = False, lineage: bool = False
) -> DataFrame:
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(*_as_list(paths))
    return with_source_file(df) if lineage else df


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def _csv_reader(spark: SparkSession, header: bool, mode: str, encoding: str, timestamp_format: str):
    return (
        spark.read.option("header", str(header).lower())
        .option("encoding", encoding)
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
        .option("mode", mode)
    )


def _in_file_order(schema: T.StructType, header: Sequence[str]) -> T.StructType:
    """The schema's fields in the order of a file's header; columns it doesn't know are text."""
    known = {f.name.lower(): f for f in schema.fields}
    names = [h.strip() for h in header]
    return T.StructType([known.get(n.lower(), T.StructField(n, T.StringType(), True)) for n in names])


def _judged_by_all_columns(df: DataFrame) -> DataFrame:
    """Whether a row fits must not depend on the columns a query happens to read.

    Spark parses only the columns that are asked for, and a value nobody asks for can't be wrong. Tying
    the text of unreadable rows to a hash of all columns has them parsed wherever that text is used.
    """
    columns = [c for c in df.columns if c != CORRUPT]
    return df.withColumn(CORRUPT, F.when(F.hash(*columns) >= F.lit(-(1 << 31)), F.col(CORRUPT)))


def _named(line: Column, names: Sequence[str]) -> Column:
    """A line's values as text by the names of its file's header, as JSON; values beyond go by number."""
    spare = [f"_more_{i}" for i in range(8)]
    fields = ", ".join(f"`{n}` string" for n in [*names, *spare])
    values = F.from_csv(line, F.lit(fields))
    told = F.to_json(F.struct(*[values.getField(n).alias(n) for n in [*names, *spare]], line.alias(LINE)))
    return F.when(line.isNotNull(), told)


def read_csv(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType | None = None,
    header: bool = True,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
    encoding: str = "UTF-8",
    timestamp_format: str = TIMESTAMP_FORMAT,
    lineage: bool = False,
    keep_named: bool = False,
) -> DataFrame:
    """Delimited text with an explicit schema; without one the types are inferred by an extra pass.

    Columns of a file with a header are matched by name: the result has the schema's columns in the
    schema's order and then, as text, those it doesn't know. A column that the file lacks is lacking in
    the result, so that a contract can refuse it. The order is that of the first file; a file with
    another header fails when it is read. Without a header columns go by position.

    ``keep_corrupt`` adds the raw text of rows that do not fit the schema as ``_corrupt_record``, and
    ``keep_named`` also the values of such a row by the names of the file's header, as JSON in
    ``_original_record``; the line itself is in it as ``_line``. So the row can be read again by name.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if schema is None and keep_corrupt:
        raise ValueError("corrupt records can be kept only with an explicit schema")
    if keep_named and not (keep_corrupt and header):
        raise ValueError("names come from the header of a file whose corrupt records are kept")
    reader = _csv_reader(spark, header, mode, encoding, timestamp_format)
    wanted = None
    if schema is None:
        reader = reader.option("inferSchema", "true")
    else:
        if header:
            names = spark.read.option("header", "true").option("encoding", encoding).csv(_as_list(paths)).columns
            known = [f.name for f in schema.fields if f.name.lower() in {n.strip().lower() for n in names}]
            schema = _in_file_order(schema, names)
            wanted = [*known, *[n for n in schema.names if n not in known]]
            reader = reader.option("enforceSchema", "false")
        if keep_corrupt:
            schema = _with_corrupt(schema)
            wanted = wanted and [*wanted, CORRUPT]
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(schema)
    df = reader.csv(_as_list(paths))
    if keep_corrupt:
        df = _judged_by_all_columns(df)
    if lineage:
        df = with_source_file(df)
        wanted = wanted and [*wanted, SOURCE_FILE]
    if keep_named:
        df = df.withColumn(ORIGINAL, _named(F.col(CORRUPT), [n.strip() for n in names]))
        wanted = [*wanted, ORIGINAL]
    return df.select(*wanted) if wanted else df


def read_json(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
    lineage: bool = False,
) -> DataFrame:
    """One JSON object per line, with an explicit schema."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    reader = spark.read.option("mode", mode)
    if keep_corrupt:
        reader = reader.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.schema(schema)
    df = reader.json(_as_list(paths))
    return with_source_file(df) if lineage else df


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, rows that do not). Only the second keeps the raw text."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull())
    return good, bad


def from_rows(
    spark: SparkSession, rows: Sequence[dict] | Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A small in-memory table such as a list of codes."""
    return spark.createDataFrame(list(rows), schema)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column that a frame lacks is NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _common_type(kinds: set[str]) -> str:
    """A type that holds every value of all the given ones; text where no other does."""
    whole = [k for k in kinds if k in WHOLE_TYPES]
    if len(whole) == len(kinds):
        return max(whole, key=WHOLE_TYPES.index)
    return "double" if kinds <= {"float", "double", "tinyint", "smallint", "int"} else "string"


def _as_text(name: str, kind: str) -> Column:
    """A value as text that reads back as the same value; whole numbers look alike in all types."""
    value = F.col(name)
    if kind not in ("float", "double"):
        return value.cast("string")
    value = value.cast("double")
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(float(1 << 53)))
    return F.when(whole, value.try_cast("bigint").cast("string")).otherwise(value.cast("string"))


def read_months(
    spark: SparkSession, paths: Paths, types: dict[str, str] | None = None, lineage: bool = False
) -> DataFrame:
    """Several deliveries as one table, given as files, folders or a mix.

    Columns that appear later are NULL in earlier files. Where files disagree on a column's type, files
    of one schema are read together. A column that ``types`` names is then cast as ``normalize_checked``
    does, file by file: a value that cannot be read is named in ``_type_errors``, and the row's text is
    kept. Any other column gets a type that holds the values of all files, text where no other does.
    """
    try:
        return read_parquet(spark, paths, merge_schema=True, lineage=lineage)
    except (PySparkException, Py4JJavaError) as refused:
        if "CANNOT_MERGE" not in str(refused):
            raise
    by_schema: dict[str, list[str]] = {}
    for file in spark.read.parquet(*_as_list(paths)).inputFiles():  # names only; a footer each below
        by_schema.setdefault(spark.read.parquet(file).schema.json(), []).append(file)
    frames = [read_parquet(spark, files, lineage=lineage) for files in by_schema.values()]
    checked, common = {}, {}
    for name in dict.fromkeys(c for f in frames for c in f.columns):
        kinds = {f.schema[name].dataType.simpleString() for f in frames if name in f.columns}
        if len(kinds) > 1 and types and name in types:
            checked[name] = types[name]
        elif len(kinds) > 1:
            common[name] = _common_type(kinds)
    united = []
    for f in frames:
        kinds = dict(f.dtypes)
        cast = [
            F.col(c) if common.get(c, kinds[c]) == kinds[c]
            else (_as_text(c, kinds[c]) if common[c] == "string" else F.col(c).cast(common[c])).alias(c)
            for c in f.columns
        ]
        united.append(normalize_checked(f.select(*cast), checked) if checked else f.select(*cast))
    return union_by_name(united)
