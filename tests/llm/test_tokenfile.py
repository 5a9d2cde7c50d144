"""Token files against the tokenizers library, and the file format on its own."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from silverlode.llm import tokenfile
from silverlode.llm.queries import VOCABULARY
from silverlode.llm.tokenfile import Reader, Writer
from silverlode.session import scratch_path

LIBRARY = Tokenizer.from_file(VOCABULARY)


def brute(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def by_start(got):
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: r[1])


def test_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert by_start(tokenfile.digests(docs.repartition(5), VOCABULARY, 1)) == brute(rows)


def test_odd_texts(spark):
    pick = random.Random(1)
    rows = [(5, None), (3, ""), (4, "A b C　d"), (-1, "<|endoftext|> x<|startoftext|>"), (9, "Ångström é ΣΣ"), (8, "\x00 \x1c\x85")]
    rows += [(100, "word " * 100_000), (101, "y" * 50_000)]
    rows += [(i, "".join(pick.choices("ab c\né世\U0001f600'sT1́", k=40))) for i in range(200, 400)]
    assert by_start(tokenfile.digests(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, 1)) == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(7, "same text")] * 500 + [(None, "no id")] * 300 + [(i, f"text {i}") for i in range(300)]
    got = by_start(tokenfile.digests(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, 1))
    assert got == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None)]])
def test_tiny_tables(spark, rows):
    assert by_start(tokenfile.digests(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, 1)) == brute(rows)


def test_extra_columns_and_files(spark):
    """Small files, opened one by one: ascending ids, each document by its own frame."""
    rows = [(i, f"document {i} " * (i % 9), i, "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part long, file string").repartition(3)
    path = scratch_path(spark, "tokens")
    tokenfile.write(docs, path, VOCABULARY, 1, file_bytes=500)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/files").where("length > 0").collect()]
    dictionary = tokenfile.read_dictionary(spark, path)
    readers = sorted((Reader(f, dictionary) for f in files), key=lambda r: (r.part, r.number))
    assert len(readers) > 8 and all(f.endswith(b"\n") for f in files)
    assert [d for r in readers for d in r.doc_ids.to_pylist()] == list(range(300))
    for doc_id in (0, 17, 299):
        (one,) = [(r, k) for r in readers for k in r.find(doc_id)]
        assert one[0].ids(one[1]).tolist() == [*LIBRARY.encode(rows[doc_id][1], add_special_tokens=False).ids, 1]
    with pytest.raises(ValueError, match="another dictionary"):
        Reader(files[0], dictionary + b"x")
    with pytest.raises(ValueError, match="not all"):
        Reader(files[0][:-5] + b"01234", dictionary)
    assert by_start(tokenfile.read_digests(spark, path)) == brute([r[:2] for r in rows])


@pytest.mark.parametrize("width", [2, 4])
def test_round_trip(width):
    pick = np.random.default_rng(3)
    texts = [pick.integers(0, 1 << (8 * width), n) for n in (0, 1, 5, 10_000, 3)]
    dictionary = tokenfile.trained([texts[2].astype(f"<u{width}").tobytes()])
    writer, files = Writer(dictionary, width, part=6, file_bytes=15_000), []
    for k, ids in enumerate(texts):
        files.append(writer.add(pa.scalar(k // 2), ids))
    files = [f for f in [*files, writer.close()] if f]
    readers = [Reader(f, dictionary) for f in files]
    assert [r.number for r in readers] == [0, 1] and {r.part for r in readers} == {6}
    got = [r.ids(k) for r in readers for k in range(len(r))]
    assert all((g == t).all() and len(g) == len(t) for g, t in zip(got, texts, strict=True))
    assert readers[0].find(0) == [0, 1] and readers[0].find(5) == [] and writer.close() is None


def test_a_shared_dictionary_makes_short_documents_small():
    pick = random.Random(8)
    words = [pick.randrange(40_000) for _ in range(500)]
    texts = [np.array(pick.choices(words[:60], k=30)) for _ in range(2000)]
    raw = [t.astype("<u2").tobytes() for t in texts]
    sizes = []
    for dictionary in (b"", tokenfile.trained(raw[:1000])):
        writer = Writer(dictionary, 2, 0)
        for k, t in enumerate(texts):
            writer.add(pa.scalar(k), t)
        sizes.append(writer.offsets[-1])
    assert sizes[1] < 0.85 * sizes[0]
