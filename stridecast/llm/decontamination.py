"""Benchmark passages in documents: latent semantic retrieval, then word-by-word checks.

Documents are read as numbers of benchmark words (all others are 0) in passages
of 64 words that overlap by half. Every word of the benchmark carries weight, less
if it stands in many passages: a passage that very many documents copy makes its own
words frequent, and is still to be found by them. A randomised singular value decomposition of the weighted
passages, documents' and items' together, gives the latent space of ``RANK`` dimensions: every task adds up its part of
A'(A W) for a random W, Spark sums the parts word by word, and the driver adds the items' part, with a weight that lets
the space follow the items, and makes an orthonormal basis. Passages whose vector in that space is
close to an item's are aligned with the item and checked by the longest common
subsequence, the longest common run, and the item's last sentence (its answer).
Runs long enough to decide alone are looked up by hash, whatever the cosine is.

Items are taken in blocks of ``ITEMS``, or fewer if they have more than ``ITEM_HALVES`` half passages; each block searches all documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.llm.text import RollingHash, bytes_of, pieces_of, spread, text_key, words_of
from stridecast.scratch import written

HALF = 32  # words in half a passage
ITEMS = 512
#: Half passages of a block's items; a longer item is a block by itself.
ITEM_HALVES = 512
#: Dimensions of the latent space.
RANK = 128
#: Weight of the items' passages against the documents' in the decomposition.
ITEM_WEIGHT = 1.0
#: The most frequent words are counted in a dense table and multiplied, the others added one by one.
OFTEN = 512
#: Passages whose candidates are held against their items' words together.
TOGETHER = 1024
#: Words whose sums travel in one row, and rows that meet in one group at first.
ROWS, MEET = 64, 64
_HASH = RollingHash(9)
_RUNS = RollingHash(10)
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
MATCHES = "doc_id bigint, item_id bigint, start_word bigint, cosine double, common double, run bigint, answer double"
#: With the hash of the text, which tells rows apart whose ids are null or repeated.
KEYED = MATCHES + ", key string"


@dataclass
class Rules:
    """What confirms a candidate; shares are of the item's words."""

    cosine: float = 0.45
    common: float = 0.8  # longest common subsequence
    paraphrase: float = 0.6  # the same, if the answer is there too
    answer: float = 0.6
    run: int = 16  # words in a row


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in lower case (A-Z) without ASCII marks at its ends, and the number of words before each text."""
    data, at = bytes_of(texts, lower=True)
    begin, end, before = words_of(data, at)
    for _ in range(4):
        begin = begin + (_MARKS[data[begin]] & (end - begin > 1)) if len(begin) else begin
        end = end - (_MARKS[data[end - 1]] & (end - begin > 1)) if len(end) else end
    return _HASH.of(_HASH.prefix_bytes(data), begin, end), before


@dataclass
class Block:
    """Some items as numbers of words; number 0 is any other word."""

    ids: list[int]
    items: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes; number i + 1


def _answer(text: str) -> str:
    """The last sentence."""
    return re.split(r"(?<=[.!?])\s+|\n", text.strip())[-1]


def _block(rows: list) -> Block:
    texts = pa.array([r["text"] for r in rows], pa.string())
    words, at = word_hashes(texts)
    vocabulary = np.unique(words)
    answers, answer_at = word_hashes(pa.array([_answer(r["text"]) for r in rows], pa.string()))

    def number(values):
        place = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
        return np.where(vocabulary[place] == values, place + 1, 0)

    cut = [number(words[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    ends = [number(answers[a:b]) for a, b in zip(answer_at[:-1], answer_at[1:], strict=True)]
    return Block([r["item_id"] for r in rows], cut, ends, vocabulary)


def _numbered(vocabulary: np.ndarray):
    """Every text as numbers of benchmark words, little-endian 32-bit."""
    bits = 18
    mask = np.uint64((1 << bits) - 1)
    maybe = np.zeros(1 << bits, bool)
    maybe[(vocabulary & mask).astype(np.int64)] = True

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                words, at = word_hashes(part.column("text"))
                out = np.zeros(len(words), "<u4")
                likely = np.flatnonzero(maybe[(words & mask).astype(np.int64)])
                place = np.minimum(np.searchsorted(vocabulary, words[likely]), len(vocabulary) - 1)
                hit = vocabulary[place] == words[likely]
                out[likely[hit]] = place[hit] + 1
                data = out.tobytes()
                cut = [data[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.record_batch([part.column("doc_id"), part.column("key"), pa.array(cut, pa.binary())], ["doc_id", "key", "words"])

    return run


@dataclass
class Passages:
    """Half passages of some documents: words in a row, halves, and which halves go on in the next."""

    words: np.ndarray
    half: np.ndarray  # of each word
    document: np.ndarray  # of each half
    first: np.ndarray  # place in its document of each half's first word
    joined: np.ndarray  # the next half is of the same document


def _passages(values: list[np.ndarray]) -> Passages:
    lengths = np.array([len(v) for v in values], np.int64)
    halves = np.maximum(-(-lengths // HALF), 1)
    base = np.cumsum(halves) - halves
    words = np.concatenate(values) if values else np.zeros(0, np.int64)
    within = spread(np.zeros(len(lengths), np.int64), lengths)
    half = np.repeat(base, lengths) + within // HALF
    document = np.repeat(np.arange(len(lengths)), halves)
    first = spread(np.zeros(len(lengths), np.int64), halves) * HALF
    joined = np.concatenate([np.diff(document) == 0, [False]]) if len(document) else np.zeros(0, bool)
    return Passages(words.astype(np.int64), half, document, first, joined)


def _groups(batches, words: int = 1 << 18):
    """doc_id with key, and numbers, of some documents at a time."""
    for batch in batches:
        ids, held, size = [], [], 0
        for doc, key, value in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "words")), strict=True):
            ids.append((doc, key))
            held.append(np.frombuffer(value, "<u4"))
            size += len(held[-1])
            if size > words:
                yield ids, held
                ids, held, size = [], [], 0
        if ids:
            yield ids, held


def _frequency(size: int):
    """In how many half passages each word stands; row 0: the number of half passages."""

    def run(batches):
        total = np.zeros(size + 1, np.int64)
        for _, values in _groups(batches):
            p = _passages(values)
            total[0] += len(p.document)
            known = p.words > 0
            pairs = np.sort(p.half[known] * (size + 1) + p.words[known])
            new = np.concatenate([[True], np.diff(pairs) != 0])[: len(pairs)]
            total += np.bincount(pairs[new] % (size + 1), minlength=size + 1)
        kept = np.flatnonzero(total)
        yield pa.record_batch([pa.array(kept), pa.array(total[kept])], ["word", "n"])

    return run


@dataclass
class Counts:
    """Words of half passages: the most frequent ones counted in a table, the others one by one, by half."""

    often: np.ndarray
    table: np.ndarray  # half x frequent word
    words: np.ndarray
    half: np.ndarray
    filled: np.ndarray  # halves that hold a word of the benchmark


def _counts(p: Passages, often: np.ndarray, size: int) -> Counts:
    place = np.full(size, -1)
    place[often] = np.arange(len(often))
    chosen = np.flatnonzero(p.words)
    words, half = p.words[chosen], p.half[chosen]
    at = place[words]
    dense = at >= 0
    table = np.bincount(half[dense] * len(often) + at[dense], minlength=len(p.document) * len(often)).astype(np.float32)
    filled = np.zeros(len(p.document), bool)
    filled[half] = True
    return Counts(often, table.reshape(len(p.document), len(often)), words[~dense], half[~dense], filled)


def _heads(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    return np.flatnonzero(np.concatenate([[True], np.diff(values) != 0]))


def _sums(p: Passages, counts: Counts, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each passage (a half and the next one of its text) the sum of its words' rows of ``table``, and whether it holds any."""
    sums = counts.table @ table[counts.often]
    if len(counts.words):
        begin = _heads(counts.half)
        sums[counts.half[begin]] += np.add.reduceat(table[counts.words], begin, axis=0)
    nxt = np.flatnonzero(p.joined)
    later = sums[nxt + 1]
    sums[nxt] += later
    return sums, counts.filled | np.concatenate([counts.filled[1:] & p.joined[:-1], [False]])


def _back(p: Passages, counts: Counts, vectors: np.ndarray, out: np.ndarray) -> None:
    """Add to each word's row of ``out`` the vectors of the passages that hold it, as often as they do."""
    held = vectors.copy()
    nxt = np.flatnonzero(p.joined)
    held[nxt + 1] += vectors[nxt]  # a half also stands in the passage that begins before it
    out[counts.often] += counts.table.T @ held
    if len(counts.words):
        order = np.argsort(counts.words, kind="stable")
        words, half = counts.words[order], counts.half[order]
        begin = _heads(words)
        out[words[begin]] += np.add.reduceat(held[half], begin, axis=0)


def _sketch(weight: np.ndarray, noise: np.ndarray, often: np.ndarray):
    """Parts of A'(A W), ``ROWS`` words to a row."""
    weighted = noise * weight[:, None]

    def run(batches):
        from pyspark import TaskContext

        total = np.zeros_like(weighted)
        for _, values in _groups(batches):
            p = _passages(values)
            counts = _counts(p, often, len(weight))
            _back(p, counts, _sums(p, counts, weighted)[0], total)
        total *= weight[:, None]
        out = [(k, total[k * ROWS : (k + 1) * ROWS]) for k in range(-(-len(total) // ROWS))]
        out = [(k, x.astype("<f4").tobytes()) for k, x in out if x.any()]
        part = TaskContext.get().partitionId() % MEET
        columns = [[k for k, _ in out], [part] * len(out), [x for _, x in out]]
        kinds = (pa.int32(), pa.int32(), pa.binary())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["rows", "part", "sums"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in table.column("sums").to_pylist())
    return pa.table({"rows": table.column("rows").slice(0, 1), "part": table.column("part").slice(0, 1), "sums": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def common_subsequence(a: list[int], places: dict[int, int], size: int) -> int:
    """Length of the longest common subsequence of ``a`` and a sequence given by the bits of each value's places."""
    full = (1 << size) - 1
    row = full
    for x in a:
        if hit := places.get(x):
            step = row & hit
            row = ((row + step) | (row - step)) & full
    return size - row.bit_count()


def _places(item: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        out[x] = out.get(x, 0) | 1 << i
    out.pop(0, None)
    return out


@dataclass
class Target:
    """An item as the check reads it."""

    words: np.ndarray
    places: dict[int, int]
    answer: np.ndarray
    answer_places: dict[int, int]
    order: np.ndarray  # places by word


def _target(item: np.ndarray, answer: np.ndarray) -> Target:
    return Target(item, _places(item), answer, _places(answer), np.argsort(item, kind="stable"))


def _equal(window: np.ndarray, target: Target) -> tuple[np.ndarray, np.ndarray]:
    """Places in the window and in the item that hold the same word."""
    known = np.flatnonzero(window)
    ordered = target.words[target.order]
    first = np.searchsorted(ordered, window[known], "left")
    counts = np.searchsorted(ordered, window[known], "right") - first
    return np.repeat(known, counts), target.order[spread(first, counts)]


def _shift(shifts: np.ndarray, votes: np.ndarray) -> int:
    """The shift with most votes; words left out or put in move the rest a little: votes nearby count too."""
    least = int(shifts.min())
    hist = np.bincount(shifts - least, votes)
    upto = np.concatenate([[0], np.cumsum(hist)])
    i = np.arange(len(hist))
    support = upto[np.minimum(i + 4, len(hist))] - upto[np.maximum(i - 3, 0)]
    best = int(np.argmax(support))
    around = hist[max(best - 3, 0) : best + 4]
    return least + max(best - 3, 0) + int(np.argmax(around))


def _longest(shifts: np.ndarray, columns: np.ndarray, size: int) -> tuple[int, int]:
    """Most equal words in a row, and the shift where they stand."""
    key = np.sort(shifts * (size + 1) + columns)
    edges = np.flatnonzero(np.concatenate([[True], np.diff(key) != 1, [True]]))
    longest = int(np.argmax(np.diff(edges)))
    return int(edges[longest + 1] - edges[longest]), int(key[edges[longest]] // (size + 1))


def check(text: np.ndarray, target: Target, weight: np.ndarray, near: int) -> tuple[int, float, int, float]:
    """Where the item would begin in the text, and its shares: common subsequence, longest run, common part of the answer.

    Shared words vote on the place, by their weight and one by one; the longest run gives a third.
    The place with the longest common subsequence counts.
    """
    item = target.words
    low, high = max(0, near - len(item)), min(len(text), near + 2 * HALF + len(item))
    window = text[low:high]
    rows, columns = _equal(window, target)
    if not len(rows):
        return near, 0.0, 0, 0.0
    shifts = rows - columns
    run, along = _longest(shifts, columns, len(item))
    spare = 3 + len(item) // 6
    best = (-1.0, 0.0, 0)
    for shift in {_shift(shifts, weight[item[columns]]), _shift(shifts, np.ones(len(shifts))), along}:
        begin, end = max(0, shift - spare), min(len(window), shift + len(item) + spare)
        part = window[begin:end].tolist()
        common = common_subsequence(part, target.places, len(item)) / len(item)
        size = len(target.answer)
        found = common_subsequence(part, target.answer_places, size) / size if size else 0.0
        best = max(best, (common, found, -shift))
    common, found, shift = best
    return low + max(-shift, 0), common, run, found


def _run_starts(words: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where ``length`` words of the benchmark stand in a row, and their hashes; ``end``: where each word's text ends."""
    others = np.concatenate([[0], np.cumsum(words == 0)])
    starts = np.arange(max(len(words) - length + 1, 0))
    starts = starts[(others[starts + length] == others[starts]) & (starts + length <= end[starts])]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    return starts, _RUNS.of(_RUNS.prefix(words.astype(np.uint64)), starts, starts + length)


def _run_lookup(items: list[np.ndarray], length: int):
    """Finds the pairs of places, in some texts and in the items, where equal runs of ``length`` words begin."""

    def flat(values: list[np.ndarray]):
        lengths = np.array([len(v) for v in values], np.int64)
        words = np.concatenate(values) if values else np.zeros(0, np.int64)
        return _run_starts(words, np.repeat(np.cumsum(lengths), lengths), length)

    places, hashes = flat(items)
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]

    def run(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        starts, found = flat(values)
        first = np.searchsorted(hashes, found, "left")
        counts = np.searchsorted(hashes, found, "right") - first
        return np.repeat(starts, counts), places[spread(first, counts)]

    return run


def _plausible(p: Passages, items: list[np.ndarray], share: float):
    """Which pairs of a passage and an item may have ``share`` of the item's words in a common subsequence.

    Only pairs are refused in which so many of the item's words do not stand anywhere in the words that ``check`` reads.
    """
    new = np.flatnonzero(np.concatenate([[True], np.diff(p.document) != 0]))
    begin = new[p.document]
    end = np.append(new, len(p.document))[p.document + 1]
    own = [np.unique(item[item > 0], return_counts=True) for item in items]
    reach = np.array([-(-len(item) // HALF) for item in items])
    width = int(max((w[-1] for w, _ in own if len(w)), default=0)) + 1

    def run(half: np.ndarray, back: np.ndarray, item: np.ndarray) -> np.ndarray:
        """``back``: how many halves before the passage the item would begin."""
        low = np.minimum(np.maximum(half - back - reach[item], begin[half]), end[half])
        high = np.maximum(np.minimum(half - back + 2 + reach[item], end[half]), low)
        base, top = int(low.min()), int(high.max())
        seen = np.zeros((top - base + 1, width), np.uint16)
        a, b = np.searchsorted(p.half, (base, top))
        seen[p.half[a:b] - base + 1, p.words[a:b]] = 1
        # Wraps around, which does no harm: a window has fewer halves than that.
        np.cumsum(seen, axis=0, dtype=np.uint16, out=seen)
        out = np.zeros(len(half), bool)
        order = np.argsort(item, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
            words, counts = own[item[some[0]]]
            found = seen[np.ix_(high[some] - base, words)] != seen[np.ix_(low[some] - base, words)]
            out[some] = found @ counts >= share * len(items[item[some[0]]]) - 1e-6
        return out

    return run


def _matches(block: Block, weight: np.ndarray, basis: np.ndarray, often: np.ndarray, rules: Rules):
    known = _passages(block.items)
    weighted = basis * weight[:, None]
    item_vectors, item_filled = _sums(known, _counts(known, often, len(weight)), weighted)
    item_norm = np.linalg.norm(item_vectors, axis=1)
    item_rows = np.flatnonzero(item_filled & (item_norm > 0))
    directions = (item_vectors[item_rows] / item_norm[item_rows][:, None]).T
    aims = [_target(i, a) for i, a in zip(block.items, block.answers, strict=True)]
    column = np.zeros(len(known.document), np.int64)
    column[item_rows] = np.arange(len(item_rows))
    runs = _run_lookup(block.items, rules.run)
    owner, back = known.document[item_rows], known.first[item_rows] // HALF

    def run(batches):
        for ids, values in _groups(batches):
            p = _passages(values)
            vectors, filled = _sums(p, _counts(p, often, len(weight)), weighted)
            length = np.linalg.norm(vectors, axis=1)
            # A passage without a direction is kept: runs may begin there.
            rows = np.flatnonzero(filled)
            vectors[rows] /= np.maximum(length[rows], 1e-20)[:, None]
            may = _plausible(p, block.items, min(rules.common, rules.paraphrase))
            in_text, in_item = runs(values)
            # Pairs of the halves where equal runs begin.
            equal = np.unique(p.half[in_text] * len(known.document) + known.half[in_item])
            equal_row, equal_aim = np.searchsorted(rows, equal // len(known.document)), column[equal % len(known.document)]
            best: dict[tuple, tuple] = {}
            tried: set[tuple] = set()
            for a in range(0, len(rows), TOGETHER):
                some = rows[a : a + TOGETHER]
                close = vectors[some] @ directions
                near, aim = np.nonzero(close >= rules.cosine)
                if len(near):
                    kept = may(some[near], back[aim], owner[aim])
                    near, aim = near[kept], aim[kept]
                x, y = np.searchsorted(equal_row, (a, a + TOGETHER))
                near, aim = np.divmod(
                    np.union1d(near * len(item_rows) + aim, (equal_row[x:y] - a) * len(item_rows) + equal_aim[x:y]), len(item_rows)
                )
                for r, c in zip(near, aim, strict=True):
                    half, item = int(some[r]), int(owner[c])
                    # Where the item begins, if its half begins where the passage does.
                    place = int(p.first[half]) - int(known.first[item_rows[c]])
                    doc = int(p.document[half])
                    if best.get((doc, item), (0,))[0] == 1.0 or (doc, item, place) in tried:
                        continue
                    tried.add((doc, item, place))
                    found = check(values[doc], aims[item], weight, place)
                    start, common, length_run, answer = found
                    if common >= rules.common or length_run >= rules.run or (common >= rules.paraphrase and answer >= rules.answer):
                        row = (common, float(close[r, c]), -start, length_run, answer)
                        best[doc, item] = max(row, best.get((doc, item), row))
            if best:
                out = [
                    (ids[doc][0], block.ids[item], -start, cosine, common, length_run, answer, ids[doc][1])
                    for (doc, item), (common, cosine, start, length_run, answer) in sorted(best.items())
                ]
                names = [c.split(" ")[0] for c in KEYED.split(", ")]
                kinds = {"cosine": pa.float64(), "common": pa.float64(), "answer": pa.float64(), "key": pa.string()}
                columns = [pa.array(x, kinds.get(n, pa.int64())) for n, x in zip(names, zip(*out, strict=True), strict=True)]
                yield pa.record_batch(columns, names)

    return run


def _search(rows: DataFrame, block: Block, rules: Rules) -> DataFrame:
    size = len(block.vocabulary)
    texts = written(rows.mapInArrow(_numbered(block.vocabulary), "doc_id bigint, key string, words binary"), "benchmark-words")
    counts = texts.mapInArrow(_frequency(size), "word bigint, n bigint")
    frequency = np.zeros(size + 1)
    for word, n in counts.groupBy("word").agg(F.sum("n")).collect():
        frequency[word] = n
    passages = max(frequency[0], 1.0)
    weight = np.log((passages + 1) / (frequency + 0.5)).clip(0.1).astype(np.float32)
    weight[0] = 0
    often = 1 + np.argsort(-frequency[1:], kind="stable")[:OFTEN]
    basis = _latent_basis(texts, block, weight, often)
    return texts.mapInArrow(_matches(block, weight, basis, often, rules), KEYED)


def _latent_basis(texts: DataFrame, block: Block, weight: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Words' rows of an orthonormal basis that a random start, multiplied by A'A, spans; A: weighted passages, items' heavier.

    The product is one step of subspace iteration: it draws the start towards the leading directions.
    """
    noise = np.random.default_rng(1).normal(size=(len(weight), RANK)).astype(np.float32)
    schema = "rows int, part int, sums binary"
    # Two steps, so that no group has a row for each task of a large cluster.
    sums = texts.mapInArrow(_sketch(weight, noise, often), schema).groupBy("rows", "part").applyInArrow(_added, schema)
    total = np.zeros(noise.shape)
    for row in sums.groupBy("rows").applyInArrow(_added, schema).toLocalIterator():
        total[row["rows"] * ROWS : (row["rows"] + 1) * ROWS] = np.frombuffer(row["sums"], "<f4").reshape(-1, RANK)
    items = _passages(block.items)
    counts = _counts(items, often, len(weight))
    own = np.zeros_like(noise)
    _back(items, counts, _sums(items, counts, noise * weight[:, None])[0], own)
    own *= weight[:, None]
    scale = ITEM_WEIGHT * max(np.linalg.norm(total), 1e-9) / max(np.linalg.norm(own), 1e-9)
    return np.linalg.qr(total + scale * own)[0].astype(np.float32)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None) -> DataFrame:
    """A row for every document and benchmark item whose passage it holds, word for word or paraphrased.

    doc_id, item_id, start_word (where the item begins, in words), cosine (in the latent space), common
    (share of the item in the longest common subsequence), run (most words in a row), answer (share of the item's
    last sentence). Words count in lower case (A-Z) without ASCII marks around them.

    Null and empty texts hold nothing; items without a word are left out. Rows that repeat an
    id each give their matches, and so do repeated items. Other columns are not read. Without documents or items there are no rows.
    """
    return _keyed_matches(docs, benchmark, F.lit(None).cast("string"), rules).drop("key")


def _keyed_matches(docs: DataFrame, benchmark: DataFrame, key: Column, rules: Rules | None) -> DataFrame:
    """``benchmark_matches`` with the documents' ``key``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("key"), F.col("text").cast("string").alias("text"))
    # The items are the stated query set; they pass the driver block by block.
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    found, block, halves = None, [], 0

    def searched(block):
        nonlocal found
        part = _search(rows, _block(block), rules or Rules())
        found = part if found is None else found.unionByName(part)

    for row in items.where(F.trim(F.coalesce("text", F.lit(""))).rlike(r"[^\x20\x09-\x0D]")).orderBy("item_id", "text").toLocalIterator():
        own = -(-len(row["text"].split()) // HALF)
        if block and (len(block) >= ITEMS or halves + own > ITEM_HALVES):
            searched(block)
            block, halves = [], 0
        block.append(row)
        halves += own
    if block:
        searched(block)
    if found is None:
        return docs.sparkSession.createDataFrame([], KEYED)
    return found


def without_benchmark(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns.

    Rows are told apart by id and text, so one goes only if its own text holds a passage, whatever its id is.
    """
    found = _keyed_matches(docs, benchmark, text_key(), rules).select(F.col("doc_id").alias("_found"), F.col("key").alias("_key"))
    found = written(found.distinct(), "leaks")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_found"]) & (text_key(docs["text"]) == found["_key"]), "left_anti")
