"""A table that is asked for many numbers at once."""

from __future__ import annotations

import numpy as np


class Lookup:
    """A table from numbers that are not negative to small numbers, asked many at once;
    -1 for what it does not hold."""

    def __init__(self, bits: int = 16):
        self.bits, self.held = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)

    def _spots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        spots = self._spots(keys)
        there = self.keys[spots]
        out = np.where(there == keys, self.values[spots], -1)
        late = np.flatnonzero((there != keys) & (there >= 0))
        while len(late):  # taken by another key: the next spot
            spots[late] = (spots[late] + 1) & (len(self.keys) - 1)
            there = self.keys[spots[late]]
            hit = there == keys[late]
            out[late[hit]] = self.values[spots[late[hit]]]
            late = late[~hit & (there >= 0)]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not held yet."""
        if 2 * (self.held + len(keys)) > len(self.keys):
            full = self.keys >= 0
            old = self.keys[full], self.values[full]
            self.__init__(int(4 * (self.held + len(keys))).bit_length())
            self.add(*old)
        self.held += len(keys)
        spots = self._spots(keys)
        while len(keys):
            free = self.keys[spots] < 0
            self.keys[spots[free]] = keys[free]
            won = self.keys[spots] == keys
            self.values[spots[won]] = values[won]
            keys, values, spots = keys[~won], values[~won], spots[~won]
            spots = (spots + 1) & (len(self.keys) - 1)
