"""Words of whole Arrow text columns as 64-bit hashes, without a loop over words.

A hash is a polynomial over random byte values (mod 2**64), finished by a mixer;
words of more than ``LONG`` bytes take xxh3 instead, so that no power table and
no work array grows with a word.  Equal words have equal hashes; 0 and 1 are
never a word's hash (they are free for marks).
"""
from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

import numpy as np

ASCII_SPACE = b" \t\n\x0b\x0c\r"
LONG = 64
BLOCK = 4 << 20
ROUND = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply); wraps around silently."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a prefix followed by one more word."""
    return mix(prefix * np.uint64(0xD6E8FEB86659FD93) + (word ^ (word >> np.uint64(32))) * ROUND)


POWERS = np.cumprod(np.full(LONG + 1, 0xA0761D6478BD642F, np.uint64))
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * ROUND)


@dataclass
class Words:
    """Words of a block of texts, in order: hash, text number, first and last
    byte (exclusive) and piece number (the same for words of one piece)."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray


class Splitter:
    """Cuts bytes into words at the bytes ``spaces`` and ``breaks``; a break
    also ends a piece.  ``lower`` folds A-Z to a-z."""

    def __init__(self, spaces: bytes = ASCII_SPACE, breaks: bytes = b"", lower: bool = True):
        self.lower = lower
        self.kind = np.zeros(256, np.uint8)
        self.kind[list(spaces)] = 1
        self.kind[list(breaks)] = 2
        self.values = VALUES.copy()
        if lower:
            self.values[65:91] = self.values[97:123]
        self.values[self.kind > 0] = 0

    def word(self, data: np.ndarray, start: int, end: int) -> bytes:
        raw = data[start:end].tobytes()
        return raw.lower() if self.lower else raw

    def split(self, offsets: np.ndarray, data: np.ndarray) -> Words:
        """Words of the texts data[offsets[i]:offsets[i + 1]]."""
        kind = self.kind[data]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[heads] = inside[heads]  # a text begins a word whatever stands before it
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        text = np.searchsorted(offsets, start, "right") - 1
        breaks = np.cumsum(kind == 2)[start]
        new = np.ones(len(start), bool)
        new[1:] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
        return Words(self._hashes(data, start, end), text, start, end, np.cumsum(new))

    def _hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        import xxhash

        out = np.zeros(len(start), np.uint64)
        if not len(start):
            return out
        long = np.flatnonzero(end - start > LONG)
        blocks = np.searchsorted(start, np.arange(start[0], end[-1], BLOCK))
        for lo, hi in pairwise(np.unique(np.concatenate([[0, len(start)], long, long + 1, blocks])).tolist()):
            a, b = start[lo], end[hi - 1]
            if hi - lo == 1 and b - a > LONG:
                continue
            s = start[lo:hi] - a
            at = np.arange(b - a) - np.repeat(s, np.diff(np.append(s, b - a)))
            out[lo:hi] = np.add.reduceat(self.values[data[a:b]] * POWERS[np.minimum(at, LONG)], s)
        out = mix(out + (end - start).astype(np.uint64) * ROUND)
        for i in long:
            out[i] = xxhash.xxh3_64_intdigest(self.word(data, start[i], end[i]))
        return np.maximum(out, np.uint64(2))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of an Arrow string column; a null is empty."""
    import pyarrow as pa

    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if not len(column) or at is None or data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]


def byte_blocks(batch, text_at: int, limit: int = BLOCK):
    """Slices of a record batch of about ``limit`` text bytes (one text at
    least): slice, offsets, bytes."""
    offsets, data = text_bytes(batch.column(text_at))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at), offsets[at:to + 1] - offsets[at], data[offsets[at]:offsets[to]]
        at = to
