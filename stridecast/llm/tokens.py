"""Token ids of whole texts by the tokenizers library, with a cache of pieces.

Both vocabularies cut a text before they merge bytes, and never inside the
pieces made here, so the ids of a text are those of its pieces one after the
other. Pieces are byte ranges of a whole batch, known by a 64-bit hash and their
length; only pieces that are new to a worker become strings and meet the
library. Texts for which this does not hold are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa

from stridecast.llm.text import RollingHash, bytes_of, spread, words_of

#: White space beyond ASCII as the tokenizers' regular expressions know it.
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The first bytes of these in UTF-8.
_WIDE_BYTES = np.zeros(256, bool)
_WIDE_BYTES[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_HASH = RollingHash(21)
#: A piece that both vocabularies cut into one run of letters and one of marks: letters up to U+00FF,
#: which are their own normal form, and ASCII marks without the apostrophe of contractions.
_SIMPLE = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary, by its rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


def pieces(data: np.ndarray, at: np.ndarray, spaces: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every piece, and the number of pieces before each text (one more entry).

    With ``spaces`` white space is kept: a word takes one space before it. The white
    space before that is one piece; before a word without a space its last sign is a piece of its own.
    """
    begin, end, before = words_of(data, at)
    if not spaces:
        return begin, end, before
    text = np.repeat(np.arange(len(at) - 1), np.diff(before))
    inside = begin > at[text]
    spaced = inside & (data[np.maximum(begin - 1, 0)] == 32) if len(begin) else inside
    begin = begin - spaced
    # Gaps before each word and after each text's last word.
    first = np.concatenate([[True], np.diff(text) != 0]) if len(text) else np.zeros(0, bool)
    gap = np.where(first, at[text], np.concatenate([[0], end[:-1]])) if len(text) else begin
    last = at[:-1].copy()
    full = np.diff(before) > 0
    last[full] = end[before[1:][full] - 1]
    alone = ~spaced & (begin - gap > 1)
    parts = [
        (begin, end),
        (gap, begin - alone),
        (begin[alone] - 1, begin[alone]),
        (last, at[1:]),
    ]
    begin, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    kept = end > begin
    begin, end = begin[kept], end[kept]
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    return begin, end, np.searchsorted(begin, at, "left")


class Encoder:
    """Ids of many texts at once. The cache is emptied when it holds ``limit`` pieces."""

    def __init__(self, path: str, spaces: bool, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaces = spaces
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        self.marks: dict[str, list[int]] = {}
        self._empty()

    def _empty(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, run: str) -> list[int]:
        """Ids of one run of characters, which the vocabulary does not cut before merging."""
        return [t.id for t in self.model.tokenize(run)]

    def _ids(self, piece: str) -> list[int] | None:
        found = _SIMPLE.fullmatch(piece)
        if found is None or len(piece) > 200:
            return None
        space, letters, marks = found.groups()
        if not self.spaces:
            letters = letters.lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_LETTERS)
        ids = self._merged(_LETTERS[32] + letters if space else letters)
        if marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            if marks not in self.marks:
                self.marks[marks] = self._merged(marks)
            ids = ids + self.marks[marks]
        return ids

    def _add(self, hashes: np.ndarray, texts: list[str]) -> None:
        found = list(map(self._ids, texts))
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(rest, self._whole([texts[i] for i in rest]), strict=True):
            found[i] = ids
        counts = np.fromiter(map(len, found), np.int64, len(found))
        total = int(counts.sum())
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.int32, total)
        starts = self.used + np.cumsum(counts) - counts
        self.used += total
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.start = np.insert(self.start, place, starts)
        self.count = np.insert(self.count, place, counts)

    def _rows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        return place, (self.known[place] == hashes) if len(self.known) else np.zeros(len(hashes), bool)

    def _is_odd(self, texts: pa.Array, data: np.ndarray, at: np.ndarray) -> list[int]:
        """Texts that must be encoded whole: those that may hold a special token, or wide white space beside other."""
        doubt = data == ord("<")
        if self.spaces:
            doubt |= _WIDE_BYTES[data]
        upto = np.concatenate([[0], np.cumsum(doubt)])
        out = []
        for i in np.flatnonzero(upto[at[1:]] > upto[at[:-1]]).tolist():
            text = texts[i].as_py()
            if any(s in text for s in self.special) or (self.spaces and _WIDE_SPACE.search(text)):
                out.append(i)
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """int32 ids of each text; null is empty."""
        if len(self.known) > self.limit or self.used > 8 * self.limit:
            self._empty()
        data, at = bytes_of(texts)
        begin, end, before = pieces(data, at, self.spaces)
        # The length is part of the hash.
        named = _HASH.of(_HASH.prefix_bytes(data), begin, end)
        distinct, first, place = np.unique(named, return_index=True, return_inverse=True)
        _, hit = self._rows(distinct)
        if not hit.all():
            raw, some = data.tobytes(), first[~hit]
            new = [raw[a:b].decode() for a, b in zip(begin[some].tolist(), end[some].tolist(), strict=True)]
            self._add(distinct[~hit], new)
        rows = self._rows(distinct)[0][place]
        counts = self.count[rows]
        ids = self.flat[spread(self.start[rows], counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])[before]
        out = [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
        for i in self._is_odd(texts, data, at):
            out[i] = np.array(self._whole([texts[i].as_py()])[0], np.int32)
        return out


@cache
def encoder(path: str, spaces: bool) -> Encoder:
    """One for each vocabulary in a worker process, so that later tasks find its cache filled."""
    return Encoder(path, spaces)
