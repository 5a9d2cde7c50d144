"""Helpers on whole batches, slices of them, and slices of slices."""

import random

import numpy as np
import pyarrow as pa
import pytest

from silverlode.llm import bpe, hmm, quality, simhash
from silverlode.llm.arrow import bounded, flat_words, raw

pick = random.Random(7)
TEXTS = [
    None if i % 17 == 0 else "".join(pick.choices(["Ab", "c", "É", " ", "\n", "\x0b", "#"], k=pick.randint(0, 60)))
    for i in range(300)
]


def brute_words(text, lower):
    data = (text or "").encode()
    return [w.decode() for w in (data.lower() if lower else data).split()]


@pytest.mark.parametrize("lower", [True, False])
@pytest.mark.parametrize(("start", "length"), [(0, 300), (1, 299), (40, 100), (299, 1), (120, 0)])
def test_words_of_slices(lower, start, length):
    part = pa.array(TEXTS).slice(start, length)
    words, bounds = flat_words(part, lower)
    words = words.to_pylist()
    got = [words[a:z] for a, z in zip(bounds[:-1], bounds[1:])]
    assert got == [brute_words(t, lower) for t in TEXTS[start : start + length]]
    assert raw(part).to_pylist() == [(t or "").encode() for t in TEXTS[start : start + length]]


def test_bounded_pieces_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": TEXTS})
    for most in (1, 50, 500, 1 << 20):
        pieces = [*bounded([batch.slice(3)], most_bytes=most)]
        assert [t for p in pieces for t in p.column("text").to_pylist()] == TEXTS[3:]
        for p in pieces:
            assert p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= most


def test_operators_do_not_depend_on_how_texts_are_cut():
    whole, batch = pa.array(TEXTS), pa.RecordBatch.from_pydict({"text": TEXTS})
    pieces = [p.column("text") for p in bounded([batch], most_bytes=300)]
    assert len(pieces) > 10
    prints = simhash.majority(*simhash.shingle_hashes(whole, 3))
    assert np.concatenate([simhash.majority(*simhash.shingle_hashes(p, 3)) for p in pieces]).tolist() == prints.tolist()
    for measure in quality.MEASURES:
        every = getattr(quality.Texts(whole), measure)
        assert np.concatenate([getattr(quality.Texts(p), measure) for p in pieces]).tolist() == every.tolist()
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = bpe.Bpe(file.read())
    assert [d for p in pieces for d in encoder.digests(p)] == encoder.digests(whole)


def test_word_counts_do_not_depend_on_how_texts_are_cut(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").coalesce(1)
    want = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in hmm.scores(docs).collect()}
    for i, t in enumerate(TEXTS):
        assert want[i][0] == len(brute_words(t, True)) + 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        again = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in hmm.scores(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert again == want
