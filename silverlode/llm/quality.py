"""Quality rules as a short-circuit cascade.

A rule measures documents and rejects some. Its cost and its share of rejections are estimated on
a sample; rules then run in the order of rejections per cost, each on the documents that all rules
before it have kept. A document is kept if no rule rejects it, so the order changes the time only,
never the verdict.

Texts are measured in batches: on the UTF-8 bytes, on lines, or on the words' numbers in the batch.

Defined results: a null text is the empty text and has no words, so it is rejected as too short;
texts of any length are measured whole; every row gets its own verdict, repeated rows the same;
other columns pass through filter_documents unchanged; an empty table gives an empty table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.arrow import bounded, flat_words, raw

#: Documents in the sample that the order is estimated on, and the most bytes one may have.
SAMPLE_ROWS, SAMPLE_BYTES = 200, 64 << 10
WINDOW = 5


def _marked(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_BLANK = _marked(b" \t\n\x0b\x0c\r")
_SYMBOL = _marked(b"#*$%&|<>")
_FOLLOWS = _marked(bytes(range(0x80, 0xC0)))  # a further byte of a code point
_UPPER = _marked(bytes(range(0x41, 0x5B)))
_LOWER = _marked(bytes(range(0x61, 0x7B)))


class Texts:
    """Texts of a batch and what has been measured on them; measures are taken when first asked for."""

    def __init__(self, texts: pa.Array):
        self.column = texts
        self.texts = raw(texts)

    def __len__(self) -> int:
        return len(self.texts)

    def take(self, rows: np.ndarray) -> Texts:
        return self if len(rows) == len(self) else Texts(self.column.take(pa.array(rows)))

    @cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray]:
        ends = np.frombuffer(self.texts.buffers()[1], np.int64)[self.texts.offset :][: len(self) + 1]
        data = self.texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        return data[ends[0] : ends[-1]], ends - ends[0]

    def _sum(self, flags: np.ndarray) -> np.ndarray:
        """Number of flagged bytes in each text."""
        ends = self._bytes[1]
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[ends[1:]] - sums[ends[:-1]]

    @cached_property
    def n_words(self) -> np.ndarray:
        data, ends = self._bytes
        inside = ~_BLANK[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        heads = ends[:-1][ends[:-1] < ends[1:]]
        starts[heads] = inside[heads]
        return self._sum(starts)

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self._sum(~(_BLANK | _FOLLOWS)[self._bytes[0]])

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._sum(_SYMBOL[self._bytes[0]])

    @cached_property
    def n_upper(self) -> np.ndarray:
        return self._sum(_UPPER[self._bytes[0]])

    @cached_property
    def n_lower(self) -> np.ndarray:
        return self._sum(_LOWER[self._bytes[0]])

    @cached_property
    def _lines(self) -> np.ndarray:
        found = np.zeros((len(self), 2), np.int64)
        for i, text in enumerate(self.texts.to_pylist()):
            lines = [x for x in text.split(b"\n") if x and not x.isspace()]
            found[i] = len(lines), len(lines) - len(set(lines))
        return found

    @property
    def n_lines(self) -> np.ndarray:
        return self._lines[:, 0]

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[:, 1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in windows that occur twice or more in their text."""
        words, bounds = flat_words(self.column, lower=False)
        ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        sizes = np.diff(bounds)
        counts = np.maximum(sizes - WINDOW + 1, 0)
        ends = np.concatenate(([0], np.cumsum(counts)))
        text = np.repeat(np.arange(len(self)), counts)
        at = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], counts)
        mixed = text.astype(np.uint64)
        for k in range(WINDOW):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[at + k]
        ordered = np.sort(mixed)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        covered = np.zeros(len(ids) + 1, np.int64)
        if len(twice):
            place = np.minimum(np.searchsorted(twice, mixed), len(twice) - 1)
            maybe = np.flatnonzero(twice[place] == mixed)  # equal mixes; now compare the words
            rows = np.stack([text[maybe].astype(np.uint64), *(ids[at[maybe] + k] for k in range(WINDOW))])
            order = np.lexsort(rows)
            same = (rows[:, order[1:]] == rows[:, order[:-1]]).all(axis=0)
            again = np.zeros(len(maybe), bool)
            again[order[1:][same]] = again[order[:-1][same]] = True
            found = at[maybe[again]]
            np.add.at(covered, found, 1)
            np.add.at(covered, found + WINDOW, -1)
        inside = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
        return inside[bounds[1:]] - inside[bounds[:-1]]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Texts], np.ndarray]


#: The two base rules.
TOO_SHORT = Rule("too_short", lambda t: t.n_words < 10)
REPEATS = Rule("repeats", lambda t: 100 * t.n_repeat_words > 20 * t.n_words)
BASE = (TOO_SHORT, REPEATS)

#: Further rules, wide enough to leave ordinary prose alone.
RULES = (
    *BASE,
    Rule("word_length", lambda t: (t.word_chars < 2 * t.n_words) | (t.word_chars > 15 * t.n_words)),
    Rule("symbols", lambda t: 100 * t.n_symbols > 10 * t.n_words),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 50 * t.n_lines),
    Rule("capitals", lambda t: 100 * t.n_upper > 50 * (t.n_upper + t.n_lower)),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimates(rules: Sequence[Rule], texts: pa.Array) -> list[Estimate]:
    """Time for and share of rejections of each rule, on its own over all of the texts."""
    found = []
    for rule in rules:
        fresh = Texts(texts)
        began = time.perf_counter()
        rejected = rule.rejects(fresh)
        found.append(Estimate(rule, time.perf_counter() - began, float(np.mean(rejected)) if len(fresh) else 0.0))
    return found


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, text_column: str = "text") -> list[Rule]:
    """The rules by rejections per cost on a sample; ties keep the given order."""
    short = docs.where(F.octet_length(docs[text_column]) <= SAMPLE_BYTES)
    sample = short.select(F.col(text_column).alias("text")).limit(SAMPLE_ROWS).collect()
    if not sample:
        return list(rules)
    found = estimates(rules, pa.array([r.text for r in sample], pa.string()))
    return [e.rule for e in sorted(found, key=lambda e: -e.worth)]


def cascade(rules: Sequence[Rule], texts: Texts) -> np.ndarray:
    """For each text the place of the first rule in this order that rejects it, or -1."""
    verdict = np.full(len(texts), -1)
    alive = np.arange(len(texts))
    for place, rule in enumerate(rules if len(texts) else ()):
        bad = rule.rejects(texts)
        verdict[alive[bad]] = place
        alive, texts = alive[~bad], texts.take(np.flatnonzero(~bad))
        if not len(alive):
            break
    return verdict


def filter_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, text_column: str = "text") -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    order = ordered(docs, rules, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(batches, text_column):
            yield part.filter(pa.array(cascade(order, Texts(part.column(text_column))) < 0))

    return docs.mapInArrow(run, docs.schema)


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, all measures, whether a base rule rejects it, and the verdict.

    The cascade decides; what it has skipped for a rejected document is measured for the report.
    """
    order = ordered(docs, rules, text_column)
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(batches):
            texts = Texts(part.column("text"))
            kept = cascade(order, texts) < 0
            failed = np.any([rule.rejects(texts) for rule in BASE], axis=0)
            measures = [pa.array(getattr(texts, m).astype(np.int64)) for m in MEASURES]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *measures, pa.array(failed), pa.array(kept & ~failed)],
                names=["doc_id", *MEASURES, "base_failed", "kept"],
            )

    columns = ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(run, f"doc_id {kind}, {columns}, base_failed boolean, kept boolean")
