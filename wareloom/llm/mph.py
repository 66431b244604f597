"""A minimal perfect hash over 64-bit keys: levels of bit arrays, ranks as indexes.

A key's index is the rank of the first set bit it hits, going down the levels.
Keys whose bit no other key of the level hits are placed there; the others go
on.  What 48 levels leave (equal keys, at most) is kept as a sorted list.
"""

from __future__ import annotations

import numpy as np

from wareloom.llm.text_hash import mix

GAMMA, LEVELS = 1.6, 48
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)


def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> bytes:
    left, sizes, bits = keys.astype(np.uint64), [], []
    while len(left) and len(sizes) < LEVELS:
        size = (int(GAMMA * len(left)) // 64 + 1) * 64
        at = _at(left, len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        here = np.zeros(size, dtype=np.uint8)
        here[at[alone]] = 1
        bits.append(np.packbits(here, bitorder="little"))
        sizes.append(size)
        left = left[~alone]
    head = np.array([len(keys), len(sizes), len(left), *sizes], dtype=np.int64)
    return head.tobytes() + np.sort(left).tobytes() + b"".join(b.tobytes() for b in bits)


class PerfectHash:
    def __init__(self, raw: bytes):
        self.n, levels, rest = (int(x) for x in np.frombuffer(raw, np.int64, 3))
        self.sizes = [int(x) for x in np.frombuffer(raw, np.int64, levels, 24)]
        at = 24 + 8 * levels
        self.rest = np.frombuffer(raw, np.uint64, rest, at)
        self.bits = np.frombuffer(raw, np.uint8, -1, at + 8 * rest) if levels else np.zeros(0, np.uint8)
        self.ranks = np.concatenate([[0], np.cumsum(_ONES[self.bits])])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of every key of the set; any index, or -1, for other keys."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = _at(keys[todo], level, size) + self.starts[level]
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            held = (self.bits[byte] >> bit) & 1 == 1
            below = self.bits[byte[held]] & ((np.uint8(1) << bit[held]) - np.uint8(1))
            out[todo[held]] = self.ranks[byte[held]] + _ONES[below]
            todo = todo[~held]
        if len(todo) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            same = self.rest[at] == keys[todo]
            out[todo[same]] = self.n - len(self.rest) + at[same]
        return out
