"""Small helpers for operators that work on Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def bounded(
    batches: Iterable[pa.RecordBatch], column: str = "text", most_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the strings of one piece hold most_bytes, or are one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + most_bytes, "right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def filled(
    batches: Iterable[pa.RecordBatch], column: str = "text", most_bytes: int = 4 << 20, row_bytes: int = 64
) -> Iterator[pa.RecordBatch]:
    """Join batches in turn while they hold no more than most_bytes, a row counting row_bytes besides its string."""
    held, size = [], 0
    for batch in batches:
        own = (pc.sum(pc.binary_length(batch.column(column))).as_py() or 0) + row_bytes * batch.num_rows
        if held and size + own > most_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.concat_batches(held)


def raw(column: pa.Array) -> pa.Array:
    """UTF-8 bytes of a string column; a null counts as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def flat_words(column: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words [^\\x20\\x09-\\x0D]+ of the rows in one array, and the rows' bounds in it.

    lower changes A-Z only. Row i has the words bounds[i] to bounds[i + 1].
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    # Lower-casing misreads strings that don't start at the beginning of their buffer, as in a slice.
    texts = pa.concat_arrays([texts, pa.array([], texts.type)])
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not real.all():
        words = words.filter(pa.array(real))
        bounds = np.concatenate(([0], np.cumsum(real)))[bounds]
    return words, bounds.astype(np.int64)


class Sequences:
    """Sequences of numbers laid out by time: all first tokens, all second ones, and so on."""

    def __init__(self, sequences: list[np.ndarray]):
        sizes = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        longest = int(sizes[0]) if len(sizes) else 0
        # How many sequences have a token at each time.
        self.alive = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), "right")
        self.start = np.concatenate(([0], np.cumsum(self.alive)))
        self.tokens = np.empty(int(sizes.sum()), np.int64)
        for rank, i in enumerate(self.order):
            self.tokens[self.start[: sizes[rank]] + rank] = sequences[i]

    def __len__(self) -> int:
        return len(self.order)
