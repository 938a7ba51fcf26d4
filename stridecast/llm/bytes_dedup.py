"""Bytes of strings that occur more than once removed.

Runs of 200-byte strings that meet under an anchor and are equal are repeats.
Runs that meet and differ are joined in one string for each task, each run once
with its number of occurrences; ``bwt`` finds which of their 200-byte strings
are equal. A task gets whole anchors, in groups of bounded size. An anchor with
more than ``LARGE`` different runs, as at the edges of a passage that very many
documents share, is not gathered: its strings go under longer anchors, and what
is crowded even there is counted by hash, with sums before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm import bwt, seeds
from stridecast.llm.seeds import written
from stridecast.llm.substring import windows_of
from stridecast.llm.text import pieces_of, spread

LARGE = 256
#: Bytes of runs joined in one transform.
JOINED = 1 << 16
#: Bytes of runs that a task transforms, on average.
TASK_BYTES = 4 << 20
SEGMENTS = f"h bigint, {seeds.DOC}, at bigint, many boolean, bytes binary"
OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _segments(unit: seeds.Unit):
    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                seq = seeds.sequence(part.column("text"), unit)
                lists = part.column("runs")
                text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                h, at, many = (lists.flatten().field(i) for i in range(3))
                at = at.to_numpy()
                low = seeds.start_of(at) + seq.at[text]
                high = np.minimum(low + seeds.count_of(at) - 1 + unit.window, seq.at[text + 1])
                data = seq.data.tobytes()
                cut = [data[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                doc = part.column("doc").take(pa.array(text))
                columns = [h, doc, pa.array(at), many, pa.array(cut, pa.binary())]
                yield pa.record_batch(columns, ["h", "doc", "at", "many", "bytes"])

    return run


def repeats_among(segments: list[bytes], counts: np.ndarray, many: np.ndarray, window: int) -> list[np.ndarray]:
    """For each segment the starts (under its count) of strings that occur more than once among all segments.

    A segment marked ``many`` stands for several equal ones.
    """
    lengths = np.array([len(s) + 1 for s in segments], np.int64)
    base = np.cumsum(lengths) - lengths
    text = np.ones(int(lengths.sum()), np.int64)  # 1 ends a segment, bytes are 2 to 257
    flat = np.frombuffer(b"".join(segments), np.uint8)
    text[spread(base, lengths - 1)] = flat.astype(np.int64) + 2
    counted = np.minimum(counts, np.maximum(lengths - window, 0))
    owner = np.full(len(text), -1, np.int64)
    owner[spread(base, counted)] = np.repeat(np.arange(len(segments)), counted)
    order, cut = bwt.prefix_cuts(text, window)
    weight = np.where(owner >= 0, 1 + many[owner], 0)[order]
    group = np.cumsum(cut) - 1
    repeated = np.zeros(len(text), bool)
    repeated[order] = np.bincount(group, weight)[group] > 1
    return [np.flatnonzero(repeated[a : a + c]) for a, c in zip(base.tolist(), counted.tolist(), strict=True)]


def _transform(window: int):
    """Ranges of repeated strings; rows come sorted by anchor, and anchors stay whole."""

    def ranges(rows):
        h, doc, at, many, segments = rows
        count = seeds.count_of(at)
        found = repeats_among(segments, count, many, window)
        out_doc, out_a, out_b = [], [], []
        for d, start, starts in zip(range(len(at)), seeds.start_of(at).tolist(), found, strict=True):
            if len(starts):
                heads = np.concatenate([[True], np.diff(starts) != 1])
                first = starts[heads]
                last = starts[np.concatenate([heads[1:], [True]])]
                out_doc += [d] * len(first)
                out_a += (first + start).tolist()
                out_b += (last + start + window).tolist()
        out_doc = doc.take(pa.array(out_doc, pa.int64()))
        return pa.record_batch([out_doc, pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["doc", "a", "b"])

    def run(batches):
        held: list[pa.RecordBatch] = []

        def whole(last: bool):
            nonlocal held
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            size = np.cumsum([len(x) for x in table.column("bytes").to_pylist()])
            begin = 0
            while begin < len(h):
                past = size[begin - 1] if begin else 0
                end = int(np.searchsorted(size, past + JOINED, "right"))
                end = int(np.searchsorted(h, h[min(end, len(h) - 1)], "left"))
                if end <= begin:
                    end = int(np.searchsorted(h, h[begin], "right"))
                if end >= len(h) or size[-1] - past <= JOINED:
                    if not last:
                        break
                    end = len(h) if size[-1] - past <= JOINED else end
                part = table.slice(begin, end - begin)
                yield ranges(
                    (
                        h[begin:end],
                        part.column("doc").combine_chunks(),
                        part.column("at").to_numpy(),
                        part.column("many").to_numpy(),
                        part.column("bytes").to_pylist(),
                    )
                )
                begin = end
            held = table.slice(begin).to_batches()

        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) > 8 * JOINED:
                yield from whole(False)
        if held:
            yield from whole(True)

    return run


def _settled(rows: DataFrame, unit: seeds.Unit, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc, a, b of repeated strings; and the runs (h, doc, at) under anchors with too many different ones."""
    same, rest = seeds.meeting_runs(found)
    rest = written(rest, "differing-runs")
    whole = same.unionByName(rest.where("times > 1").drop("h")).select("doc", *seeds.run_range(unit))
    # One run for all equal ones goes on.
    reps = rest.where((F.col("doc") == F.col("least")) & ~seeds.is_again())
    size = written(reps.groupBy("h").agg(F.count("*").alias("runs")), "run-sizes")
    reps = written(reps.join(size, "h").select("h", "doc", "at", (F.col("times") > 1).alias("many"), "runs"), "open-runs")
    few = reps.where(F.col("runs") <= LARGE)
    listed = few.groupBy("doc").agg(F.collect_set(F.struct("h", "at", "many")).alias("runs"))
    # A transform costs far more than its bytes' share of a shuffle: tasks are cut by its work.
    start, end = seeds.run_range(unit)
    total = few.agg(F.sum(end - start)).first()[0] or 0
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    segments = rows.join(listed, "doc").select("doc", "text", "runs").mapInArrow(_segments(unit), SEGMENTS)
    dealt = segments.repartition(tasks, "h").sortWithinPartitions("h")
    small = dealt.mapInArrow(_transform(unit.window), f"{seeds.DOC}, a bigint, b bigint")
    return whole.unionByName(small), reps.where(F.col("runs") > LARGE).select("h", "doc", "at")


def repeated_ranges(rows: DataFrame, unit: seeds.Unit) -> DataFrame:
    """doc, a, b: bytes covered by strings that start elsewhere too.

    The strings of runs under a crowded anchor are put under longer anchors, in shorter
    runs, which settles most of them; those still crowded are counted one by one, by hash.
    A run that stands for several was settled with them; it goes on for those that differ from it.
    """
    ranges, crowded = _settled(rows, unit, seeds.runs(rows, unit))
    longer = seeds.Unit(unit.words, unit.window, unit.window - max(1, (unit.window - unit.gram) // 6))
    again = seeds.shorter_runs(rows, crowded, longer)
    more, crowded = _settled(rows, longer, again)
    found = written(windows_of(rows, crowded, longer), "windows")
    twice = found.groupBy("h", "w").agg(F.count("*").alias("times")).where("times > 1")
    start = F.shiftright("at", 1)
    single = found.join(written(twice, "repeated-windows"), ["h", "w"])
    return ranges.unionByName(more).unionByName(single.select("doc", start.alias("a"), (start + unit.window).alias("b")))


def without_repeats(docs: DataFrame, window: int = 200, gram: int = 64) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (runs of removed bytes) and kept (the bytes left) of every row.

    A byte of the UTF-8 text goes if it is covered by a string of ``window`` bytes
    that also starts anywhere else, in this or another row; overlaps count, and
    strings are judged on the input. Strings do not cross texts.

    Null and empty texts have no bytes. Ids may be null or repeated: every row is judged by its own text. A row that
    repeats an id and text is another place for its strings, and both rows get the same result.
    Other columns are not read. An empty table gives no rows.
    """
    unit = seeds.Unit(False, window, gram)
    rows = seeds.plain(docs)

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                seq = seeds.sequence(part.column("text"), unit)
                gone = seeds.covered(part, seq.at)
                out = []
                for a, b in zip(seq.at[:-1].tolist(), seq.at[1:].tolist(), strict=True):
                    mask = gone[a:b]
                    spans = int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum())
                    out.append((b - a, int(mask.sum()), spans, seq.data[a:b][~mask].tobytes()))
                n, removed, spans, kept = zip(*out, strict=True)
                columns = [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, removed, spans)), pa.array(kept, pa.binary())]
                yield pa.record_batch(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return seeds.with_ranges(rows, repeated_ranges(rows, unit)).mapInArrow(run, OUT)
