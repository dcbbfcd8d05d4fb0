"""Look-ups of many numbers at once."""

from __future__ import annotations

import numpy as np


class Index:
    """Places of distinct 64-bit numbers: a hash table that many numbers are looked up in at once."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length() + 1))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._first(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several numbers for one slot the last one stays
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each number, -1 for one that is not here."""
        at = self._first(keys)
        found = self.slots[at]
        if not len(self.keys):
            return found
        other = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(other):
            at[other] = (at[other] + 1) & (len(self.slots) - 1)
            found[other] = self.slots[at[other]]
            other = other[(found[other] >= 0) & (self.keys[found[other]] != keys[other])]
        return found
