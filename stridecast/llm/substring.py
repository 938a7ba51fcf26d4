"""Words of repeated passages removed: seeds from winnowed anchors, extended both ways.

Runs of windows that meet under an anchor are the seeds. A run equal to an
earlier one is a repeat as a whole; a run that differs from those it meets is
extended window by window. The union of repeated windows of a document is its
maximal repeats over the threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm import seeds
from stridecast.llm.text import pieces_of
from stridecast.scratch import written

OUT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"


def _windows(unit: seeds.Unit):
    """A row for each window of the runs listed with a text: anchor, hash, document, start times two plus the mark of a repeat."""

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                seq = seeds.sequence(part.column("text"), unit)
                lists = part.column("runs")
                places, text, owner = seeds.listed_windows(seq, unit, lists)
                h = lists.flatten().field("h").to_numpy()[owner]
                starts = places - seq.at[text]
                w = seeds.window_hash(seq, places, unit).view(np.int64)
                order = np.lexsort((starts, w, text))
                again = np.zeros(len(w), np.int64)
                again[order[1:]] = (np.diff(w[order]) == 0) & (np.diff(text[order]) == 0)
                if len(w):
                    doc = part.column("doc").take(pa.array(text))
                    yield pa.record_batch([pa.array(h), pa.array(w), doc, pa.array(2 * starts + again)], ["h", "w", "doc", "at"])

    return run


def windows_of(rows: DataFrame, reps: DataFrame, unit: seeds.Unit) -> DataFrame:
    """h, w, doc, at for every window of the runs ``reps`` (h, doc, at)."""
    listed = reps.groupBy("doc").agg(F.collect_set(F.struct("h", "at")).alias("runs"))
    return rows.join(listed, "doc").mapInArrow(_windows(unit), f"h bigint, w bigint, {seeds.DOC}, at bigint")


def repeated_ranges(rows: DataFrame, unit: seeds.Unit) -> DataFrame:
    """doc, a, b: words covered by windows that start earlier too."""
    same, rest = seeds.meeting_runs(seeds.runs(rows, unit))
    rest = written(rest, "differing-runs")
    later = (F.col("doc") > F.col("least")) | seeds.is_again()
    whole = same.where(later).unionByName(rest.where(later).drop("h")).select("doc", *seeds.run_range(unit))
    found = written(windows_of(rows, rest.where(~later).select("h", "doc", "at"), unit), "windows")
    first = found.groupBy("h", "w").agg(F.min("doc").alias("least"), F.count("*").alias("times")).where("times > 1")
    single = found.join(written(first, "first-windows"), ["h", "w"]).where((F.col("doc") > F.col("least")) | (F.col("at") % 2 == 1))
    start = F.shiftright("at", 1)
    return whole.unionByName(single.select("doc", start.alias("a"), (start + unit.window).alias("b")))


def without_repeats(docs: DataFrame, window: int = 20, gram: int = 5) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of every row.

    A word goes if it is covered by a window of ``window`` words that also starts
    earlier: in a document with a smaller id, or before in the same one. Windows
    are judged on the input. Words are what stands between ASCII white space.

    Null and empty texts have no words. A null id is smaller than all others. Rows that share an id, or
    have none, are different documents if their texts differ, in the order of a hash of the text; rows
    with the same text too are one document, and each gets its result.
    Other columns are not read. An empty table gives no rows.
    """
    unit = seeds.Unit(True, window, gram)
    rows = seeds.plain(docs)

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                seq = seeds.sequence(part.column("text"), unit)
                gone = seeds.covered(part, seq.at)
                n = np.diff(seq.at)
                upto = np.concatenate([[0], np.cumsum(gone)])
                kept = []
                data = seq.data.tobytes()
                begin, end = seq.begin.tolist(), seq.end.tolist()
                for a, b in zip(seq.at[:-1].tolist(), seq.at[1:].tolist(), strict=True):
                    left = (np.flatnonzero(~gone[a:b]) + a).tolist()
                    kept.append(b" ".join([data[begin[i] : end[i]] for i in left]).decode())
                columns = [part.column("doc_id"), pa.array(n), pa.array(upto[seq.at[1:]] - upto[seq.at[:-1]]), pa.array(kept, pa.string())]
                yield pa.record_batch(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return seeds.with_ranges(rows, repeated_ranges(rows, unit)).mapInArrow(run, OUT)
