"""Documents packed into windows of equal capacity by multiway differencing.

Every document is cut into full windows and a rest; the rest is cut into grains.
A task collects grains until they fill ``windows`` windows but for ``slack`` ids
each, cutting the last one to measure, and deals them out by Karmarkar and Karp's
differencing over that many bins. If a bin exceeds the capacity the number of
bins rises by one and the grains are dealt again.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.text import pieces_of
from stridecast.llm.tokens import encoder

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def differencing(sizes: np.ndarray, bins: int) -> np.ndarray:
    """Bin of every size.

    Each size begins as a partial partition with one bin filled. The two partial
    partitions with the greatest difference between their fullest and emptiest bin
    are merged, the fullest bin of one with the emptiest of the other, until one is left.
    """
    n = len(sizes)
    following = np.full(n, -1, np.int64)  # the next size in the same bin
    heap = []
    for i, size in enumerate(sizes.tolist()):
        heapq.heappush(heap, (-size, i, np.array([size]), np.array([i]), np.array([i])))
    # Only filled bins are stored, fullest first; the rest of the bins are empty.
    while len(heap) > 1:
        _, i, sums, head, tail = heapq.heappop(heap)
        _, _, sums2, head2, tail2 = heapq.heappop(heap)
        over = len(sums) + len(sums2) - bins
        if over <= 0:
            sums, head, tail = (np.concatenate(x) for x in ((sums, sums2), (head, head2), (tail, tail2)))
        else:
            # The last ``over`` bins of the first meet the last ones of the second, in opposite order.
            a, b = slice(len(sums) - over, None), slice(len(sums2) - over, None)
            following[tail[a]] = head2[b][::-1]
            both = sums[a] + sums2[b][::-1]
            sums = np.concatenate([sums[: len(sums) - over], both, sums2[: len(sums2) - over]])
            head = np.concatenate([head, head2[: len(head2) - over]])
            tail = np.concatenate([tail[: len(tail) - over], tail2[b][::-1], tail2[: len(tail2) - over]])
        order = np.argsort(-sums, kind="stable")
        sums, head, tail = sums[order], head[order], tail[order]
        least = int(sums[-1]) if len(sums) == bins else 0
        heapq.heappush(heap, (least - int(sums[0]), i, sums, head, tail))
    out = np.zeros(n, np.int64)
    if heap:
        at, label = heap[0][3], np.arange(len(heap[0][3]))
        while len(at):
            out[at] = label
            at = following[at]
            label, at = label[at >= 0], at[at >= 0]
    return out


def _windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    bins = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = differencing(sizes, bins)
        if np.bincount(found, sizes).max() <= capacity:
            return found
        bins += 1


class _Packer:
    """Pieces of one task: doc row, start, length and window, with the ids."""

    def __init__(self, capacity: int, grain: int, windows: int, slack: int, first: int):
        self.capacity, self.grain, self.sequence = capacity, grain, first
        self.target = windows * (capacity - slack)
        self.waiting: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.held = 0

    def _close(self, out: list) -> None:
        if not self.waiting:
            return
        found = _windows(np.array([len(w[2]) for w in self.waiting]), self.capacity)
        order, last, offset = np.argsort(found, kind="stable"), -1, 0
        for i in order.tolist():
            doc, start, ids, total = self.waiting[i]
            offset = 0 if found[i] != last else offset
            last = found[i]
            out.append((doc, start, ids, total, self.sequence + int(last), offset))
            offset += len(ids)
        self.sequence += int(found.max()) + 1
        self.waiting, self.held = [], 0

    def add(self, doc, ids: np.ndarray, out: list) -> None:
        total, full = len(ids), len(ids) // self.capacity * self.capacity
        for a in range(0, full, self.capacity):
            out.append((doc, a, ids[a : a + self.capacity], total, self.sequence, 0))
            self.sequence += 1
        a = full
        while a < total:
            b = min(total, a + self.grain, a + self.target - self.held)
            self.waiting.append((doc, a, ids[a:b], total))
            self.held += b - a
            a = b
            if self.held == self.target:
                self._close(out)

    def rest(self, out: list) -> None:
        self._close(out)


def _batch(rows: list) -> pa.RecordBatch:
    doc, start, ids, total, sequence, offset = zip(*rows, strict=True)
    columns = [
        pa.array(doc, pa.int64()),
        pa.array(start, pa.int64()),
        pa.array([len(x) for x in ids], pa.int64()),
        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
        pa.array(total, pa.int64()),
        pa.array(sequence, pa.int64()),
        pa.array(offset, pa.int64()),
    ]
    return pa.record_batch(columns, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack(
    docs: DataFrame,
    tokenizer: str,
    spaces: bool = True,
    end_id: int = 1,
    capacity: int = 2048,
    grain: int = 256,
    windows: int = 128,
    slack: int = 1,
) -> DataFrame:
    """Pieces of all documents with the window each lies in, and their ids as little-endian unsigned 32-bit integers.

    A task packs the rows it reads, so nothing is shuffled and memory is bounded by
    one group of ``windows`` windows; only the last group of a task can be part full.
    Window numbers are unique, not consecutive: a task counts from its own number times 2**40.
    Null and empty texts are one end id. Rows that repeat an id are packed each; a
    null id stays null. Other columns are not read. An empty table gives no rows.
    """

    def run(batches):
        from pyspark import TaskContext

        ids_of = encoder(tokenizer, spaces).encode
        packer = _Packer(capacity, grain, windows, slack, TaskContext.get().partitionId() << 40)
        out: list = []
        end = np.array([end_id], np.int32)
        for batch in batches:
            for part in pieces_of(batch, "text"):
                ids = ids_of(part.column("text"))
                for doc, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    packer.add(doc, np.concatenate([x, end]), out)
                if out:
                    yield _batch(out)
                    out = []
        packer.rest(out)
        if out:
            yield _batch(out)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def with_crc(pieces: DataFrame) -> DataFrame:
    """The ids replaced by their CRC-32."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
