"""Words and hashes of whole Arrow batches in numpy, without a Python loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bytes that separate words.
WHITE_BYTES = (9, 10, 11, 12, 13, 32)
_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_key(text: Column | None = None) -> Column:
    """128 bits of a text; with the id they tell rows apart. A null text counts as an empty one."""
    text = F.col("text") if text is None else text
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class RollingHash:
    """Hashes of any slice of a sequence from prefix sums of powers, modulo 2**64.

    Elements are spread over 64 bits first, so two different slices collide with
    a chance near 2**-64. Two hashes with different seeds make 128 bits.
    """

    def __init__(self, seed: int):
        self.salt = np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        self.base = int(mix(np.array([seed + 77], np.uint64))[0]) | 1
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) <= n:
            size = max(n + 1, 2 * len(self.power))
            for name, base in (("power", self.base), ("inverse", _inverse(self.base))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """``values``: uint64. The result has one more entry and serves ``of``."""
        self._grow(len(values))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ self.salt) * self.power[: len(values)], out=out[1:], dtype=np.uint64)
        return out

    def prefix_bytes(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        table = mix(np.arange(1, 257, dtype=np.uint64) ^ self.salt)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * self.power[: len(data)], out=out[1:], dtype=np.uint64)
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def pieces_of(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Slices of ``batch`` with at most ``limit`` bytes of text each, or one longer text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, begin = np.cumsum(lengths), 0
    while begin < len(lengths):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def bytes_of(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, and where each begins (one more entry at the end). Null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    if len(at) == 0:
        at = np.zeros(1, np.int64)
    return (_LOWER[data] if lower else data), at - at[0]


def words_of(data: np.ndarray, at: np.ndarray, white: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of every word, and the number of words before each text (one more entry). ``white``: by byte."""
    black = ~white[data]
    begins, ends = black.copy(), black.copy()
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins[1:] &= ~black[:-1] | edge[1:-1]
    ends[:-1] &= ~black[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, at, "left")


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(len(values))

    def lesser(values, at, step):
        less = values[step:] < values[:-step]
        return np.where(less, values[step:], values[:-step]), np.where(less, at[step:], at[:-step])

    span = 1
    while 2 * span <= width:
        values, at = lesser(values, at, span)
        span *= 2
    if span < width:
        values, at = lesser(values, at, width - span)
    return at[:n]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, … counts[0] values, then the same for the next."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)
