"""Pseudonymisation, classification, erasure and the leak check."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions.predicates import count_where
from silverlode.functions.scalars import hashed, truncated


class PiiClass(str, Enum):
    """What a column says about a person, and hence what happens to it."""

    HIGH = "hash"
    MEDIUM = "truncate"
    LOW = "keep"
    NONE = "keep as is"


def pseudonymize(df: DataFrame, columns: Sequence[str], salt: str | None = None) -> DataFrame:
    """Replace each column by ``<column>_hashed``."""
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, *[hashed(c, salt).alias(f"{c}_hashed") for c in columns])


def apply_policy(
    df: DataFrame, policy: dict[str, PiiClass], length: int = 10, salt: str | None = None
) -> DataFrame:
    """Hash high-risk columns, truncate medium-risk ones, keep the rest; one projection."""
    unknown = sorted(set(policy) - set(df.columns))
    if unknown:
        raise ValueError(f"policy names unknown columns {unknown}")
    out = []
    for c in df.columns:
        risk = policy.get(c, PiiClass.NONE)
        if risk is PiiClass.HIGH:
            out.append(hashed(c, salt).alias(f"{c}_hashed"))
        elif risk is PiiClass.MEDIUM:
            out.append(truncated(c, length).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _text_key(salt: str) -> Column:
    return F.lit(hashlib.sha256(f"original text {salt}".encode()).hexdigest()[:32])


def sealed(df: DataFrame, policy: dict[str, PiiClass], salt: str | None, text: str = "_original_record") -> DataFrame:
    """The policy for rows that did not make it, where a column may be missing or hashed already."""
    return sealed_columns(sealed_text(df, policy, salt, text), policy, salt)


def sealed_text(df: DataFrame, policy: dict[str, PiiClass], salt: str | None, text: str = "_original_record") -> DataFrame:
    """The original text of a row holds its personal columns too: it is encrypted with a key made from the
    salt, so that such rows can be read again. Without a salt it is not kept.
    """
    if not policy or text not in df.columns:
        return df
    kept = F.base64(F.aes_encrypt(F.col(text), _text_key(salt))) if salt else F.lit(None).cast("string")
    return df.withColumn(text, kept)


def sealed_columns(df: DataFrame, policy: dict[str, PiiClass], salt: str | None) -> DataFrame:
    """The policy for columns that may be missing, hashed already, or both from row to row; doing it twice changes nothing."""
    for c in [c for c, risk in policy.items() if risk is PiiClass.HIGH and c in df.columns and f"{c}_hashed" in df.columns]:
        df = df.withColumn(f"{c}_hashed", F.coalesce(hashed(c, salt), f"{c}_hashed")).drop(c)
    return apply_policy(df, {c: risk for c, risk in policy.items() if c in df.columns}, salt=salt) if policy else df


def unsealed(df: DataFrame, salt: str, text: str = "_original_record") -> DataFrame:
    """The original text of sealed rows in the clear; NULL where it was sealed with another salt."""
    return df.withColumn(text, F.try_aes_decrypt(F.unbase64(F.col(text)), _text_key(salt)).cast("string"))


def generalised_codes(df: DataFrame, column: str, k: int, length: int) -> DataFrame:
    """What to show of each code so that at least ``k`` rows share what is shown: (code, shown, n).

    Codes get shorter by one character at a time, from ``length`` characters on. Those that share what
    is left of them with k rows in all stay as they are; the others go on. What is left at the empty
    code, if fewer than k, takes the smallest of the other groups along, the first by its code. NULL is
    a code of its own kind: it is shown as the empty one. With fewer than k rows in all everything is.

    Only codes with their counts are grouped, once per character.
    """
    code = F.col(column).cast("string")
    open_codes = df.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    shown = F.substring(F.coalesce("code", F.lit("")), 1, length)
    now = open_codes.withColumns({"shown": shown, "_done": F.lit(False)})
    for left in range(length, 0, -1):
        # A code is judged at its own length, and again whenever it has lost a character.
        here = ~F.col("_done") & (F.length("shown") == left)
        total = F.sum(F.when(here, F.col("n"))).over(Window.partitionBy("shown", here))
        now = now.withColumn("_total", total).withColumn("_done", F.col("_done") | (here & (F.col("_total") >= k)))
        now = now.withColumn("shown", F.when(here & ~F.col("_done"), F.substring("shown", 1, left - 1)).otherwise(F.col("shown")))
    groups = now.groupBy("shown").agg(F.sum("n").alias("_size"))
    # One row: the rest's size, and the smallest other group.
    rest = groups.agg(
        F.coalesce(F.sum(F.when(F.col("shown") == "", F.col("_size"))), F.lit(0)).alias("_rest"),
        F.min(F.when(F.col("shown") != "", F.struct("_size", "shown"))).alias("_least"),
    )
    told = rest.select(F.struct("_rest", F.col("_least.shown").alias("least")).alias("told")).scalar()
    goes = (told["_rest"] > 0) & (told["_rest"] < k) & (F.col("shown") == told["least"])
    return now.select("code", F.when(goes, "").otherwise(F.col("shown")).alias("shown"), "n")


def generalise(df: DataFrame, column: str, k: int, length: int) -> DataFrame:
    """The column with what ``generalised_codes`` shows of it, in every row."""
    told = generalised_codes(df, column, k, length).select(F.col("code").alias("_code"), "shown")
    joined = df.join(told, F.col(column).cast("string").eqNullSafe(F.col("_code")))
    return joined.select(*[F.col("shown").alias(column) if c == column else F.col(c) for c in df.columns])


def erase(
    df: DataFrame,
    subjects: DataFrame,
    column: str,
    subject_column: str,
    hashed_with: str | None = None,
    is_hashed: bool = False,
) -> DataFrame:
    """Remove the rows of listed subjects; rows without a subject stay.

    ``is_hashed`` says that ``df`` holds hashes (clean layer) while the list holds raw ids. The list is
    not hinted: Spark broadcasts it when it is small and otherwise joins by shuffle, where AQE splits
    a hot subject.
    """
    wanted = F.col(subject_column).cast("string")
    key = hashed(wanted, hashed_with) if is_hashed else wanted
    listed = subjects.select(key.alias("_subject")).distinct()
    match = F.col(column).cast("string") == F.col("_subject")
    return df.join(listed, match, "left_anti")


def assert_no_raw_columns(df: DataFrame, columns: Sequence[str]) -> None:
    leaked = [c for c in columns if c in df.columns]
    if leaked:
        raise ValueError(f"raw personal columns present: {leaked}")


def leak_counts(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Rows per string column and pattern that still look like raw personal data."""
    text = [f for f, t in df.dtypes if t == "string"]
    checks = {f"{c}:{name}": F.col(c).rlike(rx) for c in text for name, rx in patterns.items()}
    wide = df.agg(*[count_where(cond).alias(name) for name, cond in checks.items()])
    return wide.unpivot([], list(checks), "check", "n")
