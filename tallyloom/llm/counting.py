"""Counts of whole-number keys inside a task, handed on in batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Keys that a task holds before it hands counts on.
MOST_HELD = 2_000_000


class Tally:
    """Adds up counts of keys over the batches of a task, so that few rows are shuffled.

    Bounded: when too many keys are held they are merged, and handed on if that leaves
    more than half. The receiver adds up what several tasks or batches say of a key.
    Columns that follow from a key can go along with it.
    """

    def __init__(self, most: int = MOST_HELD) -> None:
        self.most, self.size = most, 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None, *others: np.ndarray) -> None:
        """Keys that occur, or keys with their counts."""
        if counts is None:
            order = np.argsort(keys)
            keys = keys[order]
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order
            counts = np.diff(np.append(starts, len(keys)))
            keys, others = keys[starts], tuple(column[order[starts]] for column in others)
        self.parts.append((keys, counts, *others))
        self.size += len(keys)

    def _merged(self) -> tuple[np.ndarray, ...]:
        keys, counts, *others = map(np.concatenate, zip(*self.parts, strict=True))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order
        return (
            keys[starts],
            np.add.reduceat(counts, starts) if len(keys) else counts,
            *(column[order[starts]] for column in others),
        )

    def crowded(self) -> bool:
        """Whether what is held must go now; it is merged first."""
        if self.size <= self.most:
            return False
        self.parts = [self._merged()]
        self.size = len(self.parts[0][0])
        return 2 * self.size > self.most

    def taken(self) -> tuple[np.ndarray, ...]:
        """All that is held, which goes: the keys, their counts and what goes along; empty without any."""
        found = self._merged() if self.parts else ()
        self.parts, self.size = [], 0
        return found

    def overflow(self, *names: str) -> Iterator[pa.RecordBatch]:
        """What must go now."""
        if self.crowded():
            yield from self.rest(*names)

    def rest(self, *names: str) -> Iterator[pa.RecordBatch]:
        """All that is held, as rows (`names`, n): the key, or the columns that go along with it."""
        if found := self.taken():
            keys, counts, *others = found
            columns = [*(others or [keys]), counts]
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column[at : at + 100_000].astype(np.int64)) for column in columns],
                    [*names, "n"],
                )
