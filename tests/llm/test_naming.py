"""Exact duplicates against a grouping by the text itself."""

import hashlib
import random

import pytest

from silverlode.llm import naming
from silverlode.llm.tables import Kept

BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups: dict[str, list] = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(BLANKS), []).append((-len(text or ""), doc_id))
    out = []
    for clean, own in groups.items():
        sha = hashlib.sha256(clean.encode()).hexdigest()
        best = min(own, key=lambda x: (x[0], x[1] is None, x[1] or 0))
        for k, x in enumerate(sorted(own, key=lambda x: (x[0], x[1] is None, x[1] or 0))):
            out.append((x[1], best[1], len(own), k == 0, sha))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = naming.exact_duplicates(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_fixture(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check(spark, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_long_texts_ties_nulls_and_repeated_rows(spark):
    pick = random.Random(5)
    long = "".join(pick.choices("abcdefgé", k=100_000))
    rows = [(1, long), (2, long[:50_000] + " \n" + long[50_000:]), (3, long[:-1]), (4, long[:8192]), (5, long[:8193])]
    rows += [(6, long[1:] + "x"), (7, long + long), (8, "  " + long + long), (9, None), (10, ""), (11, " \t"), (12, "\x1c")]
    rows += [(13, "same"), (13, "same"), (13, "s ame"), (None, "same"), (14, "a\x00b"), (15, "a\x00b")]
    check(spark, rows)


def test_levels_do_not_mix(spark):
    """With tiny blocks the same names occur on several levels."""
    kept = Kept()
    texts = ["a", "aa", "aaa", "aaaa", "aaaaa", "ab", "ba", "abab", "abba", "aaaa", "abab", ""] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = naming.identities(kept, docs, ["doc_id"], block=1).collect()
    named = {r.doc_id: (r.blocks, r.name) for r in got}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (named[i] == named[j]) == (a == b), (a, b)


def test_one_text_many_times(spark):
    rows = [(i, "copy of one text" if i % 3 else f"text {i}") for i in range(3000)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_tiny_tables(spark, rows):
    check(spark, rows)


def test_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a", 5, "n"), (2, "a ", 6, "m")], "doc_id long, text string, chunk long, names string")
    assert naming.exact_duplicates(docs).where("kept").first().doc_id == 2
