"""Long common prefixes from a Burrows-Wheeler transform, by increasing length.

Rows are the suffixes of a string in order. All rows whose suffixes begin with
the same string ω form an interval, and putting a character c before ω gives the
interval of cω. Breadth-first over lengths: where an interval of length l is
cut for the first time, the intervals one character longer are cut at the images
of the rows on both sides of the cut. So prefix lengths appear in increasing
order, and the search ends at the least length that matters.
"""

from __future__ import annotations

import numpy as np

from stridecast.llm.text import spread


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` characters at least; ``text`` holds values from 1 to 510."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = key * 512 + padded[i : i + n]
    known = 7
    while True:
        # The last order keeps equal suffixes by place, so those one character longer are in the same order.
        order = np.argsort(key, kind="stable" if known >= depth else None)
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if known >= depth or new[-1] == n - 1:
            return order
        rank = np.zeros(n + known, np.int64)
        rank[order] = new + 1
        key = rank[:n] * (n + 1) + rank[known : known + n]
        known *= 2


def prefix_cuts(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and for every row whether it shares less than ``least`` characters with the row before."""
    order = suffix_array(text, least)
    n = len(order)
    cut = np.zeros(n, bool)
    cut[0] = True
    before = text[order - 1].astype(np.uint16)  # the transform; the first suffix has none
    before[order == 0] = 0
    by_char = np.argsort(before, kind="stable")
    # Row of cω for a row of ω: characters in order, equal ones in the order of their rows.
    # The whole text's row has no character before it; the shortest suffix comes first of its kind.
    image = np.full(n, -1, np.int32)  # a text is far shorter than 2**31
    initial = text[order]
    counts = np.bincount(initial, minlength=512)
    place = np.cumsum(counts) - counts
    first_of = np.concatenate([[True], np.diff(before[by_char]) != 0])
    nth = np.arange(n) - np.maximum.accumulate(np.where(first_of, np.arange(n), 0))
    chars = before[by_char].astype(np.int64)
    # The last character's own suffix has an empty rest, which is no row: it stands first among its kind.
    nth = nth + (chars == text[-1])
    image[by_char] = np.where(chars > 0, place[chars] + nth, -1)
    previous = np.full(n, -1, np.int32)
    previous[by_char[1:]] = np.where(first_of[1:], -1, by_char[:-1])
    start = np.zeros(n, np.int32)
    stop = np.zeros(n, np.int32)
    stop[0] = n
    fresh = np.flatnonzero(np.concatenate([[False], np.diff(initial) != 0]))
    # A row whose rest is empty differs from the next of its kind after one character.
    short = int(place[text[-1]]) + 1
    cut[fresh] = True
    for length in range(1, least):
        if length == 1 and short < n and initial[short] == text[-1] and not cut[short]:
            later = np.array([short])
        else:
            later = np.zeros(0, np.int64)
        if not len(fresh) and not len(later):
            break
        if len(fresh):
            old = np.unique(start[fresh])
            rows = spread(old, stop[old] - old)
            begin = start[rows]
            now = np.maximum.accumulate(np.where(cut[rows], rows, 0))
            start[rows] = now
            heads = np.flatnonzero(np.concatenate([[True], np.diff(now) != 0]))
            stop[now[heads]] = np.concatenate([now[heads][1:], [0]])
            ends = np.concatenate([heads[1:], [len(rows)]]) - 1
            stop[now[heads]] = rows[ends] + 1
            split = (previous[rows] >= begin) & (previous[rows] < now)
            later = np.union1d(later, image[rows[split]])
        fresh = later[~cut[later]]
        cut[fresh] = True
    return order, cut
