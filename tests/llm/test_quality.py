"""Quality rules against plain Python, and the cascade against all rules at once."""

import random
import re

import numpy as np
import pyarrow as pa

from silverlode.llm import quality


def brute(text: str | None) -> dict:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for own in windows.values() if len(own) > 1 for i in own for k in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    measures = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": again,
        "n_repeat_words": len(covered),
    }
    return measures | {"base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words)}


def check(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r.asDict() for r in quality.judged(docs).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        want = brute(text)
        assert {k: rows[i][k] for k in want} == want, text
        assert not (rows[i]["kept"] and rows[i]["base_failed"])
    return rows


def test_fixture(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check(spark, [r.text for r in docs.select("text").collect()])


def test_labelled_documents_of_good_quality_stay(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    rows = quality.judged(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_edge_cases(spark):
    pick = random.Random(2)
    texts = [None, "", " ", "\n\n", "a", "a b c d e", "a " * 11, "é ü x\x1cy", "x\r\ny\n\x0bx\ny\n \n"]
    texts += [" ".join(pick.choices("abc", k=pick.randint(0, 40))) for _ in range(200)]
    texts += ["\n".join(pick.choices(["a b", "c", "", " ", "a b "], k=9)) for _ in range(50)]
    texts += [" ".join(f"w{i}" for i in range(50_000)), "word " * 30_000, "x" * 300_000]
    check(spark, texts)


def test_cascade_gives_the_same_verdicts_in_any_order():
    pick = random.Random(4)
    texts = pa.array([" ".join(pick.choices(["Ab", "#", "word", "LOUD", "x" * 40], k=pick.randint(0, 30))) for _ in range(300)])
    every = np.any([r.rejects(quality.Texts(texts)) for r in quality.RULES], axis=0)
    for _ in range(6):
        rules = pick.sample(quality.RULES, len(quality.RULES))
        verdict = quality.cascade(rules, quality.Texts(texts))
        assert ((verdict >= 0) == every).all()
        for i, place in enumerate(verdict):
            own = quality.Texts(texts.slice(i, 1))
            first = next((k for k, r in enumerate(rules) if r.rejects(own)[0]), -1)
            assert place == first


def test_later_rules_see_only_what_earlier_ones_kept():
    seen = []
    first = quality.Rule("first", lambda t: t.n_words < 2)
    second = quality.Rule("second", lambda t: seen.append(len(t)) or t.n_words > 99)
    quality.cascade([first, second], quality.Texts(pa.array(["a", "a b", None, "a b c"])))
    assert seen == [2]


def test_rules_run_by_rejections_per_cost(spark):
    import time

    def slow(t):
        time.sleep(0.05)
        return np.ones(len(t), bool)

    never = quality.Rule("never", lambda t: np.zeros(len(t), bool))
    dear = quality.Rule("dear", slow)
    cheap = quality.Rule("cheap", lambda t: np.ones(len(t), bool))
    docs = spark.createDataFrame([("a b",)] * 20, "text string")
    assert [r.name for r in quality.ordered(docs, [never, dear, cheap])] == ["cheap", "dear", "never"]
    empty = docs.limit(0)
    assert [r.name for r in quality.ordered(empty, [never, dear])] == ["never", "dear"]
    assert quality.judged(empty.selectExpr("1 AS doc_id", "text")).count() == 0


def test_filter_keeps_columns(spark):
    good = "Ordinary words that make up a plain sentence without any trouble at all here."
    rows = [(1, good, "n", [1]), (2, None, None, None), (3, good.upper(), "kept", [2]), (1, good, "n", [1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words array<int>")
    left = quality.filter_documents(docs)
    assert left.schema == docs.schema
    assert [r.doc_id for r in left.collect()] == [1, 1]
