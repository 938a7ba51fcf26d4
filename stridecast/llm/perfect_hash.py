"""A minimal perfect hash of 64-bit keys: every key of a fixed set gets a slot of its own, without gaps.

Levels of bit arrays: a key sits in the first level where no other remaining key
falls on its bit, and its slot is the number of set bits before it. About three
bits a key; building and looking up handle whole arrays of keys.
"""

from __future__ import annotations

import numpy as np

from stridecast.llm.text import mix


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ mix(np.array([level + 1], np.uint64))) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (as booleans) of the levels for distinct ``keys``."""
    levels = []
    while len(keys):
        size = 2 * len(keys)
        at = _place(keys, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
    return levels


class PerfectHash:
    """Slots of keys; a key outside the set may get a slot too, so callers compare fingerprints."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        before, self.ranks = 0, []
        for bits in levels:
            upto = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(upto + (before - 1))
            before += int(upto[-1])
        self.size = before

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level holds it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = _place(keys[left], level, len(bits))
            here = bits[at]
            out[left[here]] = ranks[at[here]]
            left = left[~here]
            if not len(left):
                break
        return out

    def packed(self) -> tuple[bytes, bytes]:
        """The sizes of the levels, and their bits one level after the other."""
        sizes = np.array([len(b) for b in self.levels], np.int64)
        return sizes.tobytes(), b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def unpacked(cls, sizes: bytes, bits: bytes) -> PerfectHash:
        levels, data, begin = [], np.frombuffer(bits, np.uint8), 0
        for size in np.frombuffer(sizes, np.int64).tolist():
            end = begin + (size + 7) // 8
            levels.append(np.unpackbits(data[begin:end], count=size).astype(bool))
            begin = end
        return cls(levels)
