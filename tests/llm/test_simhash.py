"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from silverlode.llm import simhash

BLANKS = " \t\n\x0b\x0c\r"


def brute_fingerprint(text: str | None, width: int = 3) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in BLANKS:
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    last = max(len(words) - width + 1, 1 if words else 0)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(last)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(rows: list[tuple[int, int]], distance: int = 2) -> dict[int, int]:
    codes = sorted({fp for _, fp in rows})
    parent = {c: c for c in codes}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    least: dict[int, int] = {}
    for doc, fp in rows:
        least[find(fp)] = min(doc, least.get(find(fp), doc))
    return {doc: least[find(fp)] for doc, fp in rows}


def check(spark, texts, **options):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = simhash.near_duplicates(docs, **options).collect()
    rows = [(i, brute_fingerprint(t)) for i, t in enumerate(texts)]
    want = brute_components(rows)
    assert len(got) == len(texts)
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == dict(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    return want


def test_texts(spark):
    pick = random.Random(1)
    word = lambda: "".join(pick.choices("abcdeé", k=pick.randint(1, 6)))
    base = [" ".join(word() for _ in range(n)) for n in (400, 300, 5, 2, 1, 60)]
    texts = [None, "", " \n", " ", *base, *base, base[0].upper(), "  " + base[0].replace(" ", "\t")]
    for text in base[:2] * 12:
        words = text.split()
        words[pick.randrange(len(words))] = word()
        texts.append(" ".join(words))
    want = check(spark, texts)
    assert len(set(want.values())) < len(texts) - 10


def test_fixture(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check(spark, [r.text for r in docs.select("text").collect()])


@pytest.mark.parametrize("distance", [0, 1, 2, 4])
def test_index_finds_all_components(distance):
    pick = np.random.default_rng(distance)
    centres = pick.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = centres[pick.integers(0, 40, 600)]
    for _ in range(3):
        codes = codes ^ (np.uint64(1) << pick.integers(0, 64, len(codes)).astype(np.uint64))
    codes = np.unique(codes)
    rank = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    codes = codes[np.argsort(rank)]
    parent = simhash.linked(codes, np.zeros(len(codes), np.int64), distance)
    rows = [(i, int(c)) for i, c in enumerate(codes)]
    assert dict(enumerate(parent.tolist())) == brute_components(rows, distance)


def test_hot_groups_are_cut_again(spark):
    """All codes share most bits; with a small limit the groups are cut down to a few bits."""
    pick = random.Random(3)
    codes = {(0xABCDEF << 30) ^ pick.getrandbits(11) ^ (pick.getrandbits(2) << 62) for _ in range(900)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    found = simhash.links(df, 2, most=40).collect()
    parent = {c: c for c in signed}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for a, b in found:
        assert ((a ^ b) % (1 << 64)).bit_count() <= 64
        parent[find(a)] = find(b)
    want = brute_components([(c, c % (1 << 64)) for c in signed])
    groups: dict[int, set] = {}
    for c in signed:
        groups.setdefault(find(c), set()).add(c)
    expect: dict[int, set] = {}
    for c, least in want.items():
        expect.setdefault(least, set()).add(c)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in expect.values()}


def test_ties_nulls_and_extra_columns(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, "a b c", None), (5, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", "component_id").na.fill(-1).collect())
    assert got == [(-1, 1), (1, 1), (1, 1), (5, 5)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0


def test_long_texts_count_every_shingle():
    text = "word " * 200_000 + "tail"
    hashes, ends = simhash.shingle_hashes(pa.array([text, "x"]), 3)
    assert np.diff(ends).tolist() == [199_999, 1]
    assert int(simhash.majority(hashes, ends)[0]) == xxhash.xxh64_intdigest(b"word word word", 42)
