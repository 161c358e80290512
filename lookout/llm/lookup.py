"""Vectorised hash index from 64-bit keys to positions (open addressing)."""

from __future__ import annotations

import numpy as np

from lookout.llm.words import U64, mix


class HashIndex:
    """Positions of distinct keys; ``find`` looks many keys up at once. Twelve
    to sixteen bytes a key."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.ascontiguousarray(keys).astype(U64)
        bits = max(4, (3 * len(keys) // 2).bit_length())
        self.mask = (1 << bits) - 1
        self.at = np.full(self.mask + 1, -1, np.int32)  # by slot
        todo = np.arange(len(keys))
        slot = self._slot(self.keys)
        while len(todo):
            free = self.at[slot] < 0
            self.at[slot[free]] = todo[free]  # of several for one slot, one stays
            lost = self.at[slot] != todo
            todo, slot = todo[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) & U64(self.mask)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it isn't there."""
        want = np.ascontiguousarray(keys).astype(U64)
        if not len(self.keys):
            return np.full(len(want), -1, np.int32)
        slot = self._slot(want)
        out = self.at[slot]  # most keys are done with the first slot
        todo = np.flatnonzero((out >= 0) & (self.keys[out] != want))
        out[todo] = -1
        slot, want = (slot[todo] + 1) & self.mask, want[todo]
        while len(todo):
            at = self.at[slot]
            some = at >= 0
            hit = some & (self.keys[at] == want)
            out[todo[hit]] = at[hit]
            on = some & ~hit
            todo, slot, want = todo[on], (slot[on] + 1) & self.mask, want[on]
        return out
