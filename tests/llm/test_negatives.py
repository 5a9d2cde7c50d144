"""Hard negatives against all products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import negatives
from silverlode.llm.negatives import Best, Search, build

SCHEMA = "id long, label long, vector array<long>"


def brute(rows, positives=5, k=10):
    fit = [(i, r, s, v) for i, (r, s, v) in enumerate(rows) if s is not None and v is not None]
    last = 1 << 62
    out = []

    def dot(v, w):
        return sum(a * b for a, b in zip(v, w, strict=False))

    for i, anchor, label, vector in fit:
        if anchor is None or anchor % 100:
            continue
        scored = [(-dot(vector, w), last if r is None else r, j, s) for j, r, s, w in fit if j != i]
        scored.sort()
        for minus, p, _, s in [x for x in scored if x[3] == label][:positives]:
            inside = [x for x in scored if x[3] != label and 30 * -minus <= 100 * -x[0] <= 90 * -minus]
            for rank, x in enumerate(inside[:k]):
                out.append((anchor, None if p == last else p, rank + 1, None if x[1] == last else x[1], -minus, -x[0]))
    return sorted(out, key=str)


def check(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    got = negatives.hard_negatives(df, F.col("id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute([r[:3] for r in rows])
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    return want


def around(pick, centre, width):
    return [x + pick.randint(-width, width) for x in centre]


def test_clusters(spark, monkeypatch):
    """Small trees, so that several groups and levels take part."""
    pick = random.Random(3)
    centres = [[pick.randint(-200, 200) for _ in range(6)] for _ in range(5)]
    rows = [(i, pick.randint(0, 3), around(pick, pick.choice(centres), 40)) for i in range(600)]
    assert len(check(spark, rows)) > 50


def test_nulls_ties_repeats_and_odd_vectors(spark):
    pick = random.Random(4)
    rows = [(i, i % 3, around(pick, [50, 50, -20], 3)) for i in range(301)]
    rows += [(None, 1, [50, 51, -20]), (None, 2, [51, 50, -20]), (900, None, [1, 2, 3]), (901, 1, None), (902, 0, [])]
    rows += [(100, 1, [50, 50]), (100, 1, [50, 50]), (1000, 7, [9, 9, 9]), (1100, 0, [0, 0, 0]), (1200, 0, [-50, -50, 20])]
    rows += [(2000 + i, i % 2, [40, 40, -10]) for i in range(90)]
    assert check(spark, rows)


def test_one_vector_many_times(spark):
    rows = [(i, int(i % 5 > 0), [30, 40, 0] if i % 3 else [29, 39, i % 7]) for i in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("id") % 2500 == 0).collect())
    assert [r[0] for r in got].count(0) == len(got) // 2
    assert got == sorted(x for x in brute(rows) if x[0] in (0, 2500))


def test_products_beyond_doubles(spark):
    big = 1 << 30
    rows = [(i, i % 2, [big // (1 + i % 4) + i, big - i * i, -i]) for i in range(150)] + [(200, 0, [1, 2, 3])]
    assert check(spark, rows)


def test_extra_columns(spark):
    pick = random.Random(5)
    rows = [(i, i % 2, around(pick, [20, 30], 9), i, "x") for i in range(120)]
    assert check(spark, rows, SCHEMA + ", row long, tree string")


@pytest.mark.parametrize("rows", [[], [(0, 1, [1, 2])], [(None, None, None)], [(0, 1, []), (1, 1, []), (2, 2, [])]])
def test_tiny_tables(spark, rows):
    check(spark, rows)


def test_whole_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [([0.5, -0.001],), ([nan, 1.0],), ([inf],), ([None, 1.0],), ([],), (None,)]
    df = spark.createDataFrame(rows, "v array<float>")
    got = [r.w for r in df.select(negatives.whole_vectors(df, "v", 256).alias("w")).collect()]
    assert got == [[128, -1], None, None, None, [], None]


@pytest.mark.parametrize("leaf", [1, 3])
def test_a_tree_covers_its_members_and_skips_others(leaf):
    pick = np.random.default_rng(7)
    centres = pick.integers(-1000, 1000, (20, 8))
    vectors = np.concatenate([c + pick.integers(-9, 10, (50, 8)) for c in centres])
    n = len(vectors)
    tree = build(vectors, np.arange(n), np.arange(n), np.arange(n) // 500, leaf)
    assert sorted(tree.order.tolist()) == list(range(n))
    assert len(tree.centre) > 20
    tree.prepare()
    query = vectors[17].astype(float)
    search = Search(tree, query, 17, 0, same=False)
    best = Best(5, low=100, high=10**9)
    search.run(best)
    scores = vectors @ vectors[17]
    want = sorted((-s, i, i) for i, s in enumerate(scores.tolist()) if i >= 500 and 100 <= s)[:5]
    assert best.found == want
    assert len(search.scored) < len(tree.centre) / 10
