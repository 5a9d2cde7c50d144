"""From documents to token digests: quality rules, exact and near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. run() writes what a stage returns as
Parquet and reads it again for the next one. All stages but the last keep the columns of documents,
extra ones included. Rows are told apart by file and row number, so repeated rows and rows without
an id are handled one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import bpe, mixing, naming, quality, simhash
from silverlode.llm.queries import VOCABULARY, table
from silverlode.llm.tables import Kept, free_name, keyed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule rejects."""
    return quality.filter_documents(docs)


def _without(rows: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(gone.select(*key), key, "left_anti").drop(*key)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the most code points, then the smallest id."""
    kept = Kept()
    rows, key = keyed(kept, docs)
    decided = kept.write(naming.duplicates(kept, rows.select(*key, "doc_id", "text"), [*key, "doc_id"]), "decided")
    return _without(rows, decided.where("NOT kept"), key)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id."""
    kept = Kept()
    rows, key = keyed(kept, docs)
    # The smallest of these is the row with the smallest id; rows with the same one go by their key.
    identity = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), *key)
    found = simhash.near_duplicates(rows.select(identity.alias("doc_id"), "text"), shingle=3, distance=2)
    gone = kept.write(found.where("doc_id <> component_id").select(*[F.col(f"doc_id.{k}").alias(k) for k in key]), "gone")
    return _without(rows, gone, key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as systematic sampling draws it, up to three times."""
    kept = Kept()
    rows, key = keyed(kept, docs)
    sizes = kept.write(rows.select(*key, "doc_id", "source", mixing.n_words(F.col("text")).alias("size")), "sizes")
    drawn = free_name("_copies", rows.columns)
    copies = kept.write(mixing.copies(kept, sizes).where("copies > 0").select(*key, F.col("copies").alias(drawn)), "copies")
    # Both sides are dealt by the key at any size; the texts needn't be sorted for it.
    taken = rows.join(copies.hint("shuffle_hash"), key).drop(*key)
    again = free_name("_again", taken.columns)
    repeated = taken.withColumn(again, F.explode(F.array_repeat(F.lit(True), F.col(drawn).cast("int"))))
    return repeated.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document in the mix."""
    return bpe.digests(docs, VOCABULARY)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("mixing sources", mix_sources),
    ("bpe encoding", encode),
]

#: SimHash components and BPE have no SQL form; the tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, before = table(spark, sf_dir, "documents"), Kept()
    for _, stage in STAGES[:-1]:
        after = Kept()
        docs = after.write(stage(spark, docs, sf_dir), "stage")
        before.drop()
        before = after
    return STAGES[-1][1](spark, docs, sf_dir)
