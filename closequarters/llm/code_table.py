"""Exact 64-bit codes to places, for lookups of whole arrays inside a task."""
from __future__ import annotations

import numpy as np

SPREAD = np.uint64(0x9E3779B97F4A7C15)
NONE = np.uint64(2**64 - 1)  # never a code


class CodeTable:
    """Exact codes to places, by open addressing with whole codes compared."""

    def __init__(self, codes: np.ndarray):
        self.bits = max(4, (2 * len(codes)).bit_length())
        self.keys = np.full(1 << self.bits, NONE)
        self.places = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(codes), dtype=np.int32), self._slots(codes)
        while len(left):
            free = self.places[slot] < 0
            self.places[slot[free]] = left[free]  # the last of several stays
            left_out = self.places[slot] != left
            left, slot = left[left_out], (slot[left_out] + 1) & (len(self.keys) - 1)
        used = self.places >= 0
        self.keys[used] = codes[self.places[used]]

    @classmethod
    def of(cls, keys: np.ndarray) -> CodeTable:
        """A table around the slots ``keys`` of another one, for ``find_slots``."""
        table = cls.__new__(cls)
        table.bits, table.keys, table.places = len(keys).bit_length() - 1, keys, None
        return table

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes * SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Places of the codes in the list given at first, -1 where missing."""
        slot = self.find_slots(codes)
        return np.where(slot >= 0, self.places[slot], -1)

    def find_slots(self, codes: np.ndarray) -> np.ndarray:
        """Slots of the codes, -1 where missing."""
        slot = self._slots(codes)
        found = self.keys[slot]
        out = np.where(found == codes, slot, -1)
        left = np.flatnonzero((found != codes) & (found != NONE))
        while len(left):
            slot_left = slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            found = self.keys[slot_left]
            hit = found == codes[left]
            out[left[hit]] = slot_left[hit]
            left = left[~hit & (found != NONE)]
        return out
