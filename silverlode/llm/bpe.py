"""Byte-pair encoding and decoding with a vocabulary file of the tokenizers library.

A word is a doubly linked list of symbols. A priority queue holds the adjacent pairs that have a
merge, by (rank, position); an entry whose symbols have changed since it was queued is skipped.
Decoding looks the ids up in the vocabulary and joins their strings, with a space between them
where the file names no decoder, as the library does.

Words are encoded one by one, so a worker keeps the frequent ones; the memory holds two
generations of CACHE words and drops the older one when the younger is full.

Defined results: a null text is the empty text (no ids, decoded text empty); texts of any length
are encoded whole; every row gives one row; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from silverlode.llm.arrow import bounded, flat_words

CACHE = 150_000
#: Bytes of text that a worker encodes at a time, or one document.
SLICE = 8 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder for a word-level BPE file with byte symbols and a word end."""

    def __init__(self, source: str, cache: int = CACHE):
        """source: the JSON text of the vocabulary file."""
        told = json.loads(source)
        model = told["model"]
        steps = [n["type"] for n in told["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or told["decoder"]:
            raise ValueError("this file is not a word-level BPE vocabulary of the supported kind")
        vocab: dict[str, int] = model["vocab"]
        self.ends = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        symbols = byte_symbols()
        self.inner = [vocab[c] for c in symbols]
        self.last = [vocab[c + self.ends] for c in symbols]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        words = told["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(own_pattern(words["pattern"]["Regex"]), regex.V1)
        self.usual = regex.compile(words["pattern"]["Regex"].replace("\\s", "\\t-\\r\\x85\\p{Z}"))
        # Only far beyond European letters do the tables differ.
        self.beyond = regex.compile("[^\x00-\u0530]")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.cache, self.young, self.old = cache, {}, {}

    def words_of(self, text: str) -> list[str]:
        """The words of a text, normalised. Blanks never are part of one, so they may stay as they are.

        Lower case goes character by character: a sigma at a word's end is like any other.
        """
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.beyond.search(text):
                return self.words.findall(text.lower())
        return self.usual.findall(text.lower())

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        merges, size = self.merges, len(ids)
        after, before = [*range(1, size), -1], [*range(-1, size - 1)]
        queue = [
            (*step, i) for i in range(size - 1) if (step := merges.get((ids[i], ids[i + 1])))
        ]
        queue = [(rank, i, made) for rank, made, i in queue]
        heapq.heapify(queue)
        while queue:
            rank, i, made = heapq.heappop(queue)
            j = after[i]
            if j < 0 or ids[i] < 0 or merges.get((ids[i], ids[j])) != (rank, made):
                continue  # stale: one of the two symbols has been merged since
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if step := merges.get((made, ids[k])):
                    heapq.heappush(queue, (step[0], i, step[1]))
            h = before[i]
            if h >= 0 and (step := merges.get((ids[h], made))):
                heapq.heappush(queue, (step[0], h, step[1]))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> list[int]:
        """Ids of one word, kept for the next time."""
        found = self.young.get(word) or self.old.get(word)
        if found is None:
            found = self.merge(word)
        if len(self.young) >= self.cache:
            self.old, self.young = self.young, {}
        if len(word) < 64:
            self.young[word] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        text = text or ""
        for piece in self.marks.split(text) if "<|" in text else [text]:
            if piece in self.special:
                ids.append(self.special[piece])
            else:
                for word in self.words_of(piece):
                    ids += self.word(word)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """Vocabulary strings of the ids; unknown ids are left out."""
        return " ".join([self.strings[i] for i in ids if i in self.strings])

    def digests(self, texts: pa.Array) -> list[tuple[int, str, str]]:
        """For each text the number of ids, and SHA-256 of the ids and of the decoded text.

        Normalisation and the cut into words don't reach across ASCII blanks, so each distinct run
        between them is encoded and decoded once, and the texts are put together from the runs.
        """
        runs, bounds = flat_words(texts, lower=False)
        runs = runs.dictionary_encode()
        ids = [self.encode(run) for run in runs.dictionary.to_pylist()]
        size = np.array([len(i) for i in ids], np.int64)
        told = pa.array(["".join([f"{x} " for x in i]) for i in ids], pa.large_string())
        said = pa.array([self.decode(i) + " " for i in ids], pa.large_string())
        at = runs.indices.to_numpy(zero_copy_only=False)
        counts = np.concatenate(([0], np.cumsum(size[at])))
        counts = counts[bounds[1:]] - counts[bounds[:-1]]
        if (empty := size[at] == 0).any():  # runs of blanks that aren't ASCII
            bounds = np.concatenate(([0], np.cumsum(~empty)))[bounds]
            at = at[~empty]
        hashes = []
        for strings in (told, said):
            joined = strings.take(pa.array(at))
            ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1][bounds].tolist()
            data = memoryview(joined.buffers()[2] or b"")
            # without the last space
            hashes.append([hashlib.sha256(data[a : max(a, z - 1)]).hexdigest() for a, z in pairwise(ends)])
        return [*zip(counts.tolist(), *hashes, strict=True)]


def newer_letters() -> str:
    """Letters and digits that the regex module knows and older Unicode tables don't, as ranges.

    The tokenizers library's tables are as old as those of Python's unicodedata.
    """
    kind = regex.compile(r"[\p{L}\p{N}]")
    found = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and kind.match(chr(c))]
    ranges: list[list[int]] = []
    for c in found:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in ranges)


def own_pattern(pattern: str) -> str:
    """The vocabulary file's word pattern for the regex module.

    Its blanks hold neither U+001C to U+001F, and its letters and digits are those of older tables.
    """
    newer = newer_letters()
    pattern = pattern.replace("[^\\s\\p{L}\\p{N}]", "(?:[^\\t-\\r\\x85\\p{Z}\\p{L}\\p{N}]|[NEWER])")
    pattern = pattern.replace("[\\p{L}]", "[\\p{L}--[NEWER]]").replace("[\\p{N}]", "[\\p{N}--[NEWER]]")
    return pattern.replace("[NEWER]", f"[{newer}]" if newer else "(?!)")


_loaded: dict[str, Bpe] = {}


def _bpe(path: str) -> Bpe:
    """The vocabulary at a path, read once in each worker."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as file:
            _loaded[path] = Bpe(file.read())
    return _loaded[path]


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, number of ids, and digests of the ids and the decoded text.

    vocabulary: path of the vocabulary file, at the same place on every executor.
    """
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary)
        for part in bounded(batches, most_bytes=SLICE):
            found = bpe.digests(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.string()),
                    pa.array([f[2] for f in found], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {DIGESTS}")


def encode(docs: DataFrame, vocabulary: str, text_column: str = "text", into: str = "ids") -> DataFrame:
    """All columns of docs, with the text's ids as an array column."""
    return _mapped(docs, text_column, into, T.ArrayType(T.IntegerType()), lambda t: _bpe(vocabulary).encode(t))


def decode(docs: DataFrame, vocabulary: str, ids_column: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of docs, with the decoded text of an array of ids; null ids count as none."""
    return _mapped(docs, ids_column, into, T.StringType(), lambda ids: _bpe(vocabulary).decode(ids or []))


def _mapped(docs: DataFrame, column: str, into: str, kind: T.DataType, of: Callable) -> DataFrame:
    fields = [f for f in docs.schema.fields if f.name != into]
    names = [f.name for f in fields]
    made = pa.string() if isinstance(kind, T.StringType) else pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                new = pa.array([of(x) for x in part.column(column).to_pylist()], made)
                kept = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*kept, new], names=[*names, into])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(into, kind)]))
