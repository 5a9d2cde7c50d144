"""Token ids of texts put together from their runs, each distinct run encoded once by a worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np


class RunStore:
    """Ids of runs of text, kept from one slice of texts to the next.

    encode: takes a list of distinct runs and gives them back piece by piece, in any order: some of the
    runs, all their ids one after the other, and how many ids each has. When a slice would fill the store
    beyond most runs, or most_chars characters, only the slice's own runs are kept of it. A worker holds a
    store for good, beside its executor's heap, so ids and places take four bytes each.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], Iterable[tuple[list[str], np.ndarray, np.ndarray]]],
        most: int = 1_000_000,
        most_chars: int = 16 << 20,
    ):
        self.encode, self.most, self.most_chars = encode, most, most_chars
        self.index: dict[str, int] = {}
        self.chars = 0
        self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)

    def _keep(self, runs: Sequence[str]) -> None:
        kept = [run for run in runs if run in self.index]
        at = np.fromiter(map(self.index.__getitem__, kept), np.int32, len(kept))
        self.ids, ends = self.joined(at, np.arange(len(at) + 1))
        self.starts, self.sizes = ends[:-1], np.diff(ends).astype(np.int32)
        self.index = dict(zip(kept, range(len(kept)), strict=True))
        self.chars = sum(map(len, kept))

    def places(self, runs: Sequence[str]) -> np.ndarray:
        """The place of each of some distinct runs in the store; those that it doesn't hold are encoded first."""
        new = [run for run in runs if run not in self.index]
        if new and (len(self.index) + len(new) > self.most or self.chars > self.most_chars):
            self._keep(runs)
        if new:
            self.chars += sum(map(len, new))
            sizes, ids = [self.sizes], [self.ids]
            for part, its_ids, its_sizes in self.encode(new):
                self.index.update(zip(part, range(len(self.index), len(self.index) + len(part)), strict=True))
                ids.append(its_ids.astype(np.int32, copy=False))
                sizes.append(its_sizes.astype(np.int32, copy=False))
            self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
            self.starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        return np.fromiter(map(self.index.__getitem__, runs), np.int32, len(runs))

    def joined(self, at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the runs at the given places, and the bounds of the texts in them.

        Text i has the runs bounds[i] to bounds[i + 1].
        """
        sizes = self.sizes[at]
        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        place = np.repeat(self.starts[at] - ends[:-1], sizes)
        place += np.arange(len(place))
        return self.ids[place], ends[bounds]
