"""Winnowed anchors of sequences: where a window of fixed length can occur again.

Every window of ``window`` elements (words or bytes) has one anchor: the gram of
``gram`` elements in it with the least hash, the leftmost of equals. Neighbouring
windows share their anchor and make a run. Equal windows have equal anchors at
equal places, so a window that occurs twice lies in runs that meet under one
anchor. Anchors that occur once end the matter for their runs, which is most of
them; equal runs are settled together; only runs that meet under an anchor and
differ somewhere are extended window by window.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.text import RollingHash, bytes_of, pieces_of, spread, window_minima, words_of
from stridecast import scratch

#: A row by its id (the higher part, so it gives the order) and 63 bits of its text's hash.
DOC = "doc decimal(38,0)"
RUN_SCHEMA = f"h bigint, s bigint, {DOC}, at bigint"
#: ``at`` holds the first window's start, the anchor's distance from it, the number of windows and the mark of a repeat.
_START, _LEFT, _COUNT = 32, 17, 1
#: Bytes of text whose runs are sought at a time: the arrays for them stay near the processor.
PIECE = 1 << 18


#: At the end of a query its shuffle files go, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, **options) -> DataFrame:
    """As ``scratch.written``; the shuffle files of the write are removed when it has ended, as nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return scratch.written(df, label, **options)
    finally:
        conf.set(_CLEANUP, before)


def start_of(at):
    return at >> _START


def count_of(at):
    return (at >> _COUNT) & 0xFFFF


@dataclass(frozen=True)
class Unit:
    """Words or bytes, the window and the gram, both in that unit."""

    words: bool
    window: int
    gram: int


@cache
def _hashes() -> tuple[RollingHash, ...]:
    return tuple(RollingHash(seed) for seed in range(11, 16))


@dataclass
class Sequence:
    """The elements of many texts in a row, with prefix hashes."""

    at: np.ndarray  # elements before each text, one more entry
    first: np.ndarray  # prefix sums for the hash of anchors
    second: np.ndarray  # for the hash of runs and windows
    data: np.ndarray
    begin: np.ndarray | None
    end: np.ndarray | None


def sequence(texts: pa.Array, unit: Unit) -> Sequence:
    word, one, two, *_ = _hashes()
    data, at = bytes_of(texts)
    if not unit.words:
        return Sequence(at, one.prefix_bytes(data), two.prefix_bytes(data), data, None, None)
    begin, end, at = words_of(data, at)
    named = word.of(word.prefix_bytes(data), begin, end)
    return Sequence(at, one.prefix(named), two.prefix(named), data, begin, end)


def window_hash(seq: Sequence, starts: np.ndarray, unit: Unit) -> np.ndarray:
    return _hashes()[2].of(seq.second, starts, starts + unit.window)


def _windows(seq: Sequence, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """Start and text number of every window."""
    counts = np.maximum(np.diff(seq.at) - unit.window + 1, 0)
    return spread(seq.at[:-1], counts), np.repeat(np.arange(len(counts)), counts)


def listed_windows(seq: Sequence, unit: Unit, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and text number of the windows of the runs listed with each text, and the run's place in the flat list."""
    at = lists.flatten().field("at").to_numpy()
    count = count_of(at)
    owner = np.repeat(np.arange(len(at)), count)
    text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[owner]
    starts = spread(start_of(at), count) + seq.at[text]
    fits = starts + unit.window <= seq.at[text + 1]
    starts, text, owner = starts[fits], text[fits], owner[fits]
    order = np.argsort(starts, kind="stable")
    return starts[order], text[order], owner[order]


def _runs(seq: Sequence, unit: Unit, starts: np.ndarray, text: np.ndarray):
    """Text number, hash of the anchor, hash of the run, packed place of every run of the given windows."""
    _, one, two, *_ = _hashes()
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4
    places = np.arange(len(seq.first) - unit.gram)
    grams = one.of(seq.first, places, places + unit.gram)
    anchor = window_minima(grams, unit.window - unit.gram + 1)[starts]
    new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(text) != 0) | (np.diff(starts) != 1)])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(starts)]]))
    low, anchor, text = starts[first], anchor[first], text[first]
    left = anchor - low
    run = two.of(seq.second, low, low + count - 1 + unit.window)
    run = run ^ (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((low, run, text))
    again = np.zeros(len(low), np.int64)
    again[order[1:]] = (np.diff(run[order]) == 0) & (np.diff(text[order]) == 0)
    at = ((low - seq.at[text]) << _START) | (left << _LEFT) | (count << _COUNT) | again
    return text, grams[anchor].view(np.int64), run.view(np.int64), at


def plain(docs: DataFrame) -> DataFrame:
    """doc_id, doc and text. Rows have the same ``doc`` if they have the same id (or none) and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A null id is smaller than all others.
    order = F.coalesce(F.col("doc_id").cast("bigint").cast("decimal(20,0)"), F.lit(Decimal(-(1 << 63) - 1)).cast("decimal(20,0)"))
    named = F.shiftrightunsigned(F.xxhash64(text), 1).cast("decimal(19,0)")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (order * F.lit(Decimal(1 << 63)) + named).cast("decimal(38,0)").alias("doc"),
        F.col("text").cast("string").alias("text"),
    )


def _as_rows(part: pa.RecordBatch, text, h, s, at) -> pa.RecordBatch:
    doc = part.column("doc").take(pa.array(text))
    return pa.record_batch([pa.array(h), pa.array(s), doc, pa.array(at)], ["h", "s", "doc", "at"])


def runs(rows: DataFrame, unit: Unit) -> DataFrame:
    """A row for every run of every text; ``rows`` from ``plain``."""

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text", PIECE):
                seq = sequence(part.column("text"), unit)
                found = _runs(seq, unit, *_windows(seq, unit))
                if len(found[0]):
                    yield _as_rows(part, *found)

    return rows.mapInArrow(run, RUN_SCHEMA)


def shorter_runs(rows: DataFrame, listed: DataFrame, unit: Unit) -> DataFrame:
    """The windows of the runs ``listed`` (doc, at) again, in runs under the longer anchors of ``unit``."""
    lists = listed.groupBy("doc").agg(F.collect_set(F.struct("at")).alias("runs"))

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text", PIECE):
                seq = sequence(part.column("text"), unit)
                starts, text, _ = listed_windows(seq, unit, part.column("runs"))
                found = _runs(seq, unit, starts, text)
                if len(found[0]):
                    yield _as_rows(part, *found)

    return rows.join(lists, "doc").select("doc", "text", "runs").mapInArrow(run, RUN_SCHEMA)


def meeting_runs(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs under anchors that occur more than once: those equal to all others there, and the rest.

    Both have doc, at, times (how often the run occurs) and least (the smallest
    document that holds it), the second also h. Sums come before the shuffle. They are
    written before they are joined: then adaptive execution can split a hot anchor
    on the other side, which it cannot behind an aggregate. So are the runs, which are read twice.
    """
    found = written(found, "runs", compression="zstd")
    anchors = found.groupBy("h").agg(
        F.min("s").alias("low"), F.max("s").alias("high"), F.count("*").alias("times"), F.min("doc").alias("least")
    )
    anchors = anchors.where("times > 1").select("h", (F.col("low") != F.col("high")).alias("differ"), "times", "least")
    met = written(found.join(written(anchors, "anchors"), "h"), "meeting-runs", compression="zstd")
    same = met.where("NOT differ").select("doc", "at", "times", "least")
    rest = met.where("differ").drop("times", "least")
    each = rest.groupBy("h", "s").agg(F.count("*").alias("times"), F.min("doc").alias("least"))
    return same, rest.join(written(each, "run-counts"), ["h", "s"]).select("h", "doc", "at", "times", "least")


def run_range(unit: Unit):
    """a and b: the elements that the windows of a run cover, b exclusive."""
    start = F.shiftright("at", _START)
    count = F.shiftright("at", _COUNT).bitwiseAND(F.lit(0xFFFF))
    return start.alias("a"), (start + count - 1 + unit.window).alias("b")


def is_again():
    """The run occurs earlier in the same document."""
    return F.col("at").bitwiseAND(F.lit(1)) == 1


def with_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows with their ranges; equal rows share them, so a list is never longer than the text has windows."""
    listed = ranges.groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))
    return rows.join(listed, "doc", "left")


def covered(part: pa.RecordBatch, at: np.ndarray) -> np.ndarray:
    """Which elements of the texts lie in a range."""
    lists = part.column("ranges")
    counts = np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    text = np.repeat(np.arange(len(counts)), counts)
    steps = np.zeros(int(at[-1]) + 1, np.int64)
    if len(flat):
        a, b = (np.minimum(flat.field(i).to_numpy() + at[text], at[text + 1]) for i in (0, 1))
        np.add.at(steps, a, 1)
        np.add.at(steps, b, -1)
    return np.cumsum(steps)[:-1] > 0
