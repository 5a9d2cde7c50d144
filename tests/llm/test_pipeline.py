"""The pipeline against brute force, and each stage on odd tables."""

import hashlib
import os
import sys
from collections import Counter

import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from llm import test_mixing, test_naming, test_simhash
from silverlode.llm import quality

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """rows: dicts of documents. The stages in plain Python; the last one by the tokenizers library."""
    rows = [r for r in rows if not any(rule.rejects(quality.Texts(pa.array([r["text"]], pa.string())))[0] for rule in quality.RULES)]
    yield rows
    groups = {}
    for r in rows:
        groups.setdefault((r["text"] or "").translate(test_naming.BLANKS), []).append(r)
    rows = [min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"])) for g in groups.values()]
    yield rows
    component = test_simhash.brute_components([(r["doc_id"], test_simhash.brute_fingerprint(r["text"])) for r in rows])
    rows = [r for r in rows if component[r["doc_id"]] == r["doc_id"]]
    yield rows
    drawn = test_mixing.brute([(r["doc_id"], r["source"], r["text"]) for r in rows])
    times = {d: taken // n for d, n, _, _, taken in drawn}
    rows = [r for r in rows for _ in range(times[r["doc_id"]])]
    yield rows
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for r in rows:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), said)]
        out.append({"doc_id": r["doc_id"], "n_tokens": len(ids), "ids_sha256": sha[0], "decoded_sha256": sha[1]})
    yield out


def bag(rows):
    return Counter(tuple(sorted(r.items(), key=str)) for r in rows)


def test_stages_and_run(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = [*brute([r.asDict() for r in docs.collect()])]
    got, n = docs, docs.count()
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want, strict=True):
        before = got
        made = stage(spark, got, sf_small)
        assert bag(r.asDict() for r in made.collect()) == bag(expected), name
        if name != "bpe encoding":
            assert made.schema == before.schema
            got = corpus_pipeline.Kept().write(made, "stage")
            assert 0 < got.count()
    assert len(want[0]) < n and len(want[1]) < len(want[0])
    assert bag(r.asDict() for r in corpus_pipeline.run(spark, sf_small).collect()) == bag(want[-1])


@pytest.mark.parametrize("place", range(4))
def test_stages_take_odd_tables(spark, tmp_path, place):
    """Nulls, repeated rows, clashing columns, and tables that are no plain read of files."""
    stage = corpus_pipeline.STAGES[place][1]
    text = "Ordinary words that make up one plain sentence without any trouble at all here."
    rows = [(1, text, "s", "x"), (1, text, "s", "x"), (None, text, None, None), (2, None, "s", "y"), (3, "", None, "z")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, source string, _metadata string")
    made = stage(spark, odd, "")
    assert made.columns == odd.columns
    found = made.collect()
    assert all(tuple(r) in rows for r in found)
    if place in (1, 2):
        assert sorted(str(r.text) for r in found if r.text) == [text]
        assert [r.doc_id for r in found if r.text] == [1]
    path = str(tmp_path / "odd")
    odd.withColumnsRenamed({"_metadata": "_file"}).write.parquet(path)
    again = stage(spark, spark.read.parquet(path), "")
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, found)) or place == 3
    assert stage(spark, spark.read.parquet(path).limit(0), "").count() == 0
