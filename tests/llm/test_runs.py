"""The store of encoded runs: any order of pieces, what is kept, and the memory it takes."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from silverlode.llm.queries import VOCABULARY
from silverlode.llm.tokenfile import Encoder


def words(n, seed=1):
    pick = random.Random(seed)
    letters = ["".join(pick.choices("etaoinshrdlu", k=pick.randint(2, 9))) for _ in range(n)]
    return [w + pick.choice(["", "", ".", ",", "!!", "'s", "9"]) for w in letters]


@pytest.mark.parametrize(("most", "most_chars"), [(1_000_000, 16 << 20), (300, 16 << 20), (1_000_000, 500)])
def test_kept_runs_have_the_ids_of_the_library(most, most_chars):
    library, encoder = Tokenizer.from_file(VOCABULARY), Encoder(VOCABULARY)
    encoder.store.most, encoder.store.most_chars = most, most_chars
    for seed in range(6):
        texts = [" ".join(words(40, seed * 10 + k // 2)) for k in range(12)]
        ids, bounds = encoder.ids(pa.array(texts))
        for text, a, z in zip(texts, bounds[:-1], bounds[1:], strict=True):
            assert ids[a:z].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.store.sizes) == len(encoder.store.index)


def test_memory_of_a_slice():
    """Ids of new runs become numbers of four bytes piece by piece, never lists of Python numbers at once."""
    encoder = Encoder(VOCABULARY)
    texts = pa.array([" ".join(words(200, k)) for k in range(400)])
    tracemalloc.start()
    try:
        ids, _ = encoder.ids(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert ids.dtype == np.int32 and peak < 80 * len(ids)
