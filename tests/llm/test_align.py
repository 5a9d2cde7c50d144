"""Alignment against common ends found by sets, and all overlaps of byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict, deque

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from silverlode.llm import align
from silverlode.llm.bpe import byte_symbols
from silverlode.llm.queries import BYTE_RANKS, PIECES

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BYTE = {c: b for b, c in enumerate(byte_symbols())}


def tokens(text):
    """Whole texts by both libraries: (id, start, end) on the two sides, or None."""
    sides = []
    a = A.encode(" " + text, add_special_tokens=False).ids
    sides.append([(i, bytes(BYTE[c] for c in A.id_to_token(i))) for i in a])
    told = [(i, B.id_to_piece(i)) for i in B.encode(text)]
    sides.append([(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()) for i, p in told])
    out = []
    for side in sides:
        if not text or b"".join(s for _, s in side) != (" " + text).encode():
            return None
        end, own = 0, []
        for i, s in side:
            own.append((i, end, end + len(s)))
            end += len(s)
        out.append(own)
    return out


def upto(side, stop):
    own = []
    while side and side[0][2] <= stop:
        own.append(side.popleft())
    return own


def brute(texts):
    parts, held = [], Counter()
    for text in texts:
        if not (found := tokens(text or "")):
            parts.append(None)
            continue
        a, b = found
        stops = sorted({z for *_, z in a} & {z for *_, z in b})
        groups, links, a, b = [], Counter(), deque(a), deque(b)
        for stop in stops:
            own_a = upto(a, stop)
            own_b = upto(b, stop)
            links.update((x[0], y[0]) for x in own_a for y in own_b if x[1] < y[2] and y[1] < x[2])
            groups.append(",".join(str(x[0]) for x in own_a) + "|" + ",".join(str(y[0]) for y in own_b))
        parts.append((len(found[0]), len(found[1]), groups, links))
        held.update(links.keys())
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    rows = []
    for part in parts:
        if part is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = part
        best = sum(n for pair, n in links.items() if held[pair] == most[pair[0]])
        total = sum(n * held[pair] for pair, n in links.items())
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((n_a, n_b, len(groups), sum(links.values()), best, total, sha))
    return rows


def check(spark, texts, extra=False):
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk string, of long")
    got = align.digests(docs if extra else docs.select("doc_id", "text"), BYTE_RANKS, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == [(i, *want) for i, want in enumerate(brute(texts))]
    return got


def test_documents(spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    check(spark, texts)


ODD = [
    None, "", " ", "  ", "\n", "a", "a b", "a  b", " a b ", "a\tb \n c", "it's we'll 'tis don 't", "x y 　z", "▁ a", "a▁b",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "你好 世界", "\U0001f600 \U0001f468‍\U0001f469", "é é", "\x00 a\x00b \x1c c \x85d",
    "café naïve İı", "1 2 3 44 555", "-- __ ** — … ﻿ a", "a ́b", "​ a ​", "    a   b",
]


def test_odd_texts(spark):
    got = check(spark, ODD * 2, extra=True)
    assert got[0][1:] == (0, 0, 0, 0, 0, 0, "") and got[ODD.index("a▁b")][1] == 0 and got[2][1] > 0


def test_long_texts(spark):
    pick = random.Random(2)
    words = ["".join(pick.choices("abcdeéß世", k=pick.randint(1, 12))) for _ in range(300)]
    check(spark, [" ".join(pick.choices(words, k=20_000)), "ab" * 30_000, "\n" * 5000, " ".join(words), " ".join(words)])


def test_several_chunks(spark, monkeypatch):
    """Every document a chunk of its own: the counts come from all chunks."""
    pick = random.Random(6)
    texts = [" ".join(pick.choices(["the", "tokens", "alignment", "zorpian"], k=12)) for _ in range(40)]
    rows = align.bounded
    monkeypatch.setattr(align, "bounded", lambda batches, most_bytes: rows(batches, most_bytes=1))
    a, b = align._sides(BYTE_RANKS, PIECES)
    import pyarrow as pa

    batch = pa.record_batch([pa.array(range(40)), pa.array(texts)], names=["doc_id", "text"])
    chunks = [align._chunk_rows(i, p.column("doc_id"), p.column("text").to_pylist(), a, b) for i, p in enumerate(align.bounded([batch], 1))]
    assert len(chunks) == 40 and all(c.num_rows == 2 for c in chunks)
    monkeypatch.undo()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    got = sorted(tuple(r)[1:] for r in align.digests(docs, BYTE_RANKS, PIECES).collect())
    assert got == sorted(brute(texts))


@pytest.mark.parametrize("rows", [[], [(None, None)], [(None, "a b")]])
def test_tiny_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in align.digests(docs, BYTE_RANKS, PIECES).collect()]
    assert got == [(r[0], *want) for r, want in zip(rows, brute([t for _, t in rows]), strict=True)]


def test_both_libraries_read_the_byte_vocabulary_alike():
    """All characters, alone and between blanks, letters, digits and signs."""
    a = align.byte_side(BYTE_RANKS)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 61 == 0)]
    texts = ["".join(f"{chr(c)} a{chr(c)}b  {chr(c)}1.{chr(c)}{chr(c)}\n{chr(c)}" for c in points[k : k + 40]) for k in range(0, len(points), 40)]
    ids, bounds = a.tokens(texts)
    for k, e in enumerate(A.encode_batch([f" {t}" for t in texts], add_special_tokens=False)):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == e.ids, texts[k]


def test_groups_as_arrays(spark):
    docs = spark.createDataFrame([(1, "tokenization works"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.groups for r in align.alignments(docs, BYTE_RANKS, PIECES).collect()}
    assert got[2] == []
    a, b = tokens("tokenization works")
    assert [i for g in got[1] for i in g.a] == [x[0] for x in a]
    assert [i for g in got[1] for i in g.b] == [x[0] for x in b]


def test_equal_runs_are_probed_by_doubling():
    class Counted(list):
        probes = 0

        def __getitem__(self, at):
            Counted.probes += isinstance(at, slice)
            return list.__getitem__(self, at)

    ends = Counted(range(1, 10_001))
    other = [*range(1, 9000), *range(9001, 10_001)]
    assert align.equal_run(ends, other, 0, 0) == 8999
    assert align.equal_run([1, 2, 3], [1, 2, 3, 4], 0, 0) == 3
    assert Counted.probes < 40


@given(st.sets(st.integers(1, 60), max_size=40), st.sets(st.integers(1, 60), max_size=40))
@settings(max_examples=300, deadline=None)
def test_groups_and_links_of_any_ends(a, b):
    a, b = sorted(a | {61}), sorted(b | {61})
    found = align.align(a, b)
    assert [a[i - 1] for i in found.a_stops] == sorted(set(a) & set(b)) == [b[j - 1] for j in found.b_stops]
    starts_a, starts_b = [0, *a], [0, *b]
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
    assert sorted(zip(found.a_links, found.b_links, strict=True)) == want
