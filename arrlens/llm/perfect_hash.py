"""Minimal perfect hashing of distinct 64-bit keys.

Each level has a row of bits, two for each key that is left. A key whose bit no
other key of the level wants has found its place; the others go on to the next
level, hashed anew. A key's index is the number of set bits before its own, so
n keys get the indexes 0 to n - 1. The mixing function is a bijection, so
distinct keys part sooner or later. Foreign keys may get an index too: callers
keep the keys in index order and compare.
"""

from __future__ import annotations

import numpy as np

from .common import MULT, mix

#: Bits of a level for each key that it is offered.
GAMMA = 2


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((level + 1) * int(MULT) & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys + step) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> list[bytes]:
    """The levels of a hash of distinct keys: each its size, and its bits."""
    levels, left = [], keys.astype(np.uint64)
    while len(left):
        size = GAMMA * len(left)
        slot = _slots(left, len(levels), size)
        alone = np.bincount(slot, minlength=size) == 1
        levels.append(np.int64(size).tobytes() + np.packbits(alone).tobytes())
        left = left[~alone[slot]]
    return levels


class PerfectHash:
    """The hash with the given levels."""

    def __init__(self, levels: list[bytes]):
        self.bits, self.rank, base = [], [], 0
        for level in levels:
            size = int(np.frombuffer(level, np.int64, 1)[0])
            bits = np.unpackbits(np.frombuffer(level, np.uint8, offset=8), count=size).view(bool)
            at = np.cumsum(bits) - 1 + base
            base += int(bits.sum())
            self.bits.append(bits)
            self.rank.append(at)
        self.size = base

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; -1 for some of the keys that it was not built for."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.bits, self.rank)):
            if not len(left):
                break
            slot = _slots(keys[left], level, len(bits))
            here = bits[slot]
            out[left[here]] = rank[slot[here]]
            left = left[~here]
        return out
