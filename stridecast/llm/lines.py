"""Lines that many documents share, removed by probing a sharded minimal perfect hash.

Spark counts the documents of every line key: (64-bit hash, 64-bit fingerprint) pairs with
partial sums in each task. The keys found often enough are dealt to shards; each shard is one
row with a minimal perfect hash and, by slot, arrays of fingerprints, counts and the largest
document. Documents probe these arrays with the hashes of their lines; a key outside the set
may reach a slot, but not its fingerprint.

If all arrays together are no larger than ``most_bytes`` every task gets them, and texts are
not shuffled. Otherwise the hashes are dealt to the shards, those of a shard with very many
probes to several copies of its arrays, and only the hits go back to the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.perfect_hash import PerfectHash, build
from stridecast.llm.text import _LOWER, _WHITE, RollingHash, bytes_of, pieces_of
from stridecast.scratch import written

OUT = "doc_id bigint, n_lines bigint, n_dropped bigint, kept string"
PARTIAL = "h bigint, f bigint, n bigint, doc bigint"
SHARD = "shard int, n bigint, sizes binary, bits binary, prints binary, counts binary, holders binary, held binary"
#: Keys of a shard, on average.
SHARD_KEYS = 1 << 15
_ONE, _TWO = RollingHash(21), RollingHash(22)
_LEAST = np.iinfo(np.int64).min


@dataclass
class Lines:
    """All lines of many texts in a row."""

    data: np.ndarray
    at: np.ndarray  # lines before each text, one more entry
    text: np.ndarray  # of each line
    begin: np.ndarray
    end: np.ndarray
    keyed: np.ndarray  # lines whose key is long enough
    h: np.ndarray  # of these
    f: np.ndarray


def lines_of(texts: pa.Array, least_chars: int) -> Lines:
    data, at = bytes_of(texts)
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(at, breaks, "right") - 1
    line_at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(at) - 1) + 1)])
    begin, end = np.empty(line_at[-1], np.int64), np.empty(line_at[-1], np.int64)
    first, last = np.zeros(line_at[-1], bool), np.zeros(line_at[-1], bool)
    first[line_at[:-1]], last[line_at[1:] - 1] = True, True
    begin[first], begin[~first] = at[:-1], breaks + 1
    end[last], end[~last] = at[1:], breaks
    black = np.flatnonzero(~_WHITE[data])
    low, high = np.searchsorted(black, begin), np.searchsorted(black, end)
    some = np.flatnonzero(low < high)
    a, b = black[low[some]], black[high[some] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = points[b] - points[a] >= least_chars
    a, b = a[long], b[long]
    lower = _LOWER[data]
    h, f = (x.of(x.prefix_bytes(lower), a, b).view(np.int64) for x in (_ONE, _TWO))
    return Lines(data, line_at, np.repeat(np.arange(len(at) - 1), np.diff(line_at)), begin, end, some[long], h, f)


def _ids(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids, the least number for null, and which are not null."""
    column = part.column("doc_id")
    return column.fill_null(_LEAST).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def _new(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where the rows of sorted columns differ from the row before."""
    out = np.zeros(len(sorted_columns[0]), bool)
    out[:1] = True
    for c in sorted_columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _summed(h, f, n, doc, has):
    order = np.lexsort((f, h))
    h, f, n, doc, has = (x[order] for x in (h, f, n, doc, has))
    first = np.flatnonzero(_new(h, f))
    if not len(first):
        return h, f, n, doc, has
    return h[first], f[first], np.add.reduceat(n, first), np.maximum.reduceat(doc, first), np.logical_or.reduceat(has, first)


def _distinct(lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and fingerprint of every key, once for each text."""
    text = lines.text[lines.keyed]
    order = np.lexsort((lines.f, lines.h, text))
    text, h, f = text[order], lines.h[order], lines.f[order]
    new = _new(text, h, f)
    return text[new], h[new], f[new]


def _count(least_chars: int, most: int = 500_000):
    """Keys with the number and the largest id of the documents that hold them, summed over parts of a task."""

    def batch_of(h, f, n, doc, has):
        columns = [pa.array(h), pa.array(f), pa.array(n), pa.array(doc, mask=~has)]
        return pa.record_batch(columns, ["h", "f", "n", "doc"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in pieces_of(batch, "text"):
                text, h, f = _distinct(lines_of(part.column("text"), least_chars))
                doc, has = _ids(part)
                held.append(_summed(h, f, np.ones(len(h), np.int64), doc[text], has[text]))
                size += len(held[-1][0])
                if size > most:
                    merged = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, size = [merged], len(merged[0])
                    if size > most // 2:
                        yield batch_of(*merged)
                        held, size = [], 0
        if held:
            yield batch_of(*_summed(*(np.concatenate(x) for x in zip(*held, strict=True))))

    return run


def _shard(table: pa.Table) -> pa.Table:
    """One row for the keys of a shard, whose number stands in every row."""
    h, f, n = (table.column(c).to_numpy() for c in ("h", "f", "n"))
    held = table.column("doc").is_valid().to_numpy()
    doc = table.column("doc").fill_null(_LEAST).to_numpy()
    # Keys that agree in the hash but not in the fingerprint cannot share a slot: the fingerprint is mixed in.
    found = PerfectHash(build(_mixed(h, f)))
    order = np.argsort(found.slots(_mixed(h, f)))
    sizes, bits = found.packed()
    row = {
        "shard": table.column("shard")[:1],
        "n": pa.array([len(h)]),
        "sizes": [sizes],
        "bits": [bits],
        "prints": [f[order].tobytes()],
        "counts": [n[order].tobytes()],
        "holders": [doc[order].tobytes()],
        "held": [np.packbits(held[order]).tobytes()],
    }
    binary = {c: pa.array(v, pa.binary()) for c, v in row.items() if isinstance(v, list)}
    return pa.table(row | binary)


def _mixed(h: np.ndarray, f: np.ndarray) -> np.ndarray:
    return h.view(np.uint64) ^ (f.view(np.uint64) << np.uint64(32))


class Arrays:
    """One shard, ready to be probed."""

    def __init__(self, row: dict):
        self.hash = PerfectHash.unpacked(row["sizes"], row["bits"])
        self.prints, self.counts, self.holders = (np.frombuffer(row[c], np.int64) for c in ("prints", "counts", "holders"))
        self.held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=row["n"]).astype(bool)

    def others_hold(self, h, f, doc, has, least: int) -> np.ndarray:
        """Which keys stand in ``least`` documents or more, of which this one is not the largest."""
        slot = self.hash.slots(_mixed(h, f))
        out = slot >= 0
        slot = slot[out]
        known = (self.prints[slot] == f[out]) & (self.counts[slot] >= least)
        same = (self.held[slot] == has[out]) & (self.holders[slot] == doc[out])
        out[out] = known & ~same
        return out


def _cut(lines: Lines, part: pa.RecordBatch, gone: np.ndarray) -> pa.RecordBatch:
    """The rows without the keyed lines marked in ``gone``."""
    drop = np.zeros(len(lines.begin), bool)
    drop[lines.keyed[gone]] = True
    n = np.diff(lines.at)
    dropped = np.bincount(lines.text[drop], minlength=len(n))
    kept = part.column("text").fill_null("").to_pylist()
    data = lines.data.tobytes() if len(drop) else b""
    for t in np.flatnonzero(dropped).tolist():
        left = np.flatnonzero(~drop[lines.at[t] : lines.at[t + 1]]) + lines.at[t]
        spans = zip(lines.begin[left].tolist(), lines.end[left].tolist(), strict=True)
        kept[t] = b"\n".join([data[a:b] for a, b in spans]).decode()
    columns = [part.column("doc_id"), pa.array(n), pa.array(dropped), pa.array(kept, pa.string())]
    return pa.record_batch(columns, ["doc_id", "n_lines", "n_dropped", "kept"])


def _probing(shared, shards: int, least: int, least_chars: int):
    """Documents probe the arrays of all shards."""

    def run(batches):
        arrays = {row["shard"]: Arrays(row) for row in shared.value}
        for batch in batches:
            for part in pieces_of(batch, "text"):
                lines = lines_of(part.column("text"), least_chars)
                doc, has = (x[lines.text[lines.keyed]] for x in _ids(part))
                shard, gone = np.mod(lines.h, shards), np.zeros(len(lines.h), bool)
                for k in np.unique(shard).tolist():
                    if k in arrays:
                        own = np.flatnonzero(shard == k)
                        gone[own] = arrays[k].others_hold(lines.h[own], lines.f[own], doc[own], has[own], least)
                yield _cut(lines, part, gone)

    return run


def _probes(least_chars: int):
    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                text, h, f = _distinct(lines_of(part.column("text"), least_chars))
                given = [part.column(c).take(pa.array(text)) for c in ("rid", "doc_id")]
                yield pa.record_batch([*given, pa.array(h), pa.array(f)], ["rid", "doc_id", "h", "f"])

    return run


def _routed(least: int):
    """Rows of one shard and slot follow each other, the arrays before the probes."""

    def run(batches):
        at, arrays = None, None
        for batch in batches:
            shard, slot, kind = (batch.column(c).to_numpy() for c in ("shard", "slot", "kind"))
            edges = [*np.flatnonzero(_new(shard, slot, kind)).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if kind[a] == 0:
                    at, arrays = (shard[a], slot[a]), Arrays(batch.slice(a, 1).to_pylist()[0])
                elif at == (shard[a], slot[a]):
                    part = batch.slice(a, b - a)
                    h, f = (part.column(c).to_numpy() for c in ("h", "f"))
                    found = pa.array(arrays.others_hold(h, f, *_ids(part), least))
                    hits = part.select(["rid", "h", "f"]).filter(found)
                    if hits.num_rows:
                        yield hits

    return run


def _routed_hits(rows: DataFrame, arrays: DataFrame, shards: int, least: int, least_chars: int, slot_rows: int) -> DataFrame:
    """rid, h and f of the lines to drop."""
    probes = written(rows.mapInArrow(_probes(least_chars), "rid binary, doc_id bigint, h bigint, f bigint"), "line-probes")
    probes = probes.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    slots = written(probes.groupBy("shard").agg(F.ceil(F.count("*") / slot_rows).cast("int").alias("slots")), "line-slots")
    dealt = probes.join(slots, "shard").withColumn("slot", F.pmod(F.xxhash64("rid"), F.col("slots")).cast("int"))
    copies = arrays.join(slots, "shard").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    both = copies.withColumn("kind", F.lit(0)).unionByName(dealt.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    both = both.drop("slots").repartition("shard", "slot").sortWithinPartitions("shard", "slot", "kind")
    return both.mapInArrow(_routed(least), "rid binary, h bigint, f bigint")


def _listed(least_chars: int):
    """Documents that got the list of their lines to drop."""

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                lines = lines_of(part.column("text"), least_chars)
                lists = part.column("gone")
                counts = np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False)
                flat = lists.flatten()
                text = np.concatenate([lines.text[lines.keyed], np.repeat(np.arange(len(counts)), counts)])
                h, f = (np.concatenate([own, flat.field(i).to_numpy()]) for i, own in enumerate((lines.h, lines.f)))
                # A line goes if its key stands in the list of its text: both fall into one group.
                order = np.lexsort((f, h, text))
                group = np.empty(len(order), np.int64)
                group[order] = np.cumsum(_new(text[order], h[order], f[order])) - 1
                n = len(lines.keyed)
                marked = np.zeros(len(order), bool)
                marked[group[n:]] = True
                yield _cut(lines, part, marked[group[:n]])

    return run


def without_common_lines(
    docs: DataFrame, least: int = 3, least_chars: int = 20, most_bytes: int = 32 << 20, shard_keys: int = SHARD_KEYS, slot_rows: int = 1 << 20
) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and kept (the lines left, joined by \\n) of every row.

    Lines are what \\n separates. A line's key is the line without ASCII white space at both ends, A-Z in
    lower case. Keys of ``least_chars`` code points or more in ``least`` documents or more lose all their
    lines, but for those in the document with the largest id that holds the key.

    A null or empty text is one empty line. Every row is a document; a null id is smaller than all
    others, and rows that share the largest id (or have none, if no row has one) all keep their lines. Other
    columns are not read. An empty table gives no rows.
    ``most_bytes`` bounds what every task gets; beyond it hashes are dealt to the shards, with the same result.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    counts = rows.mapInArrow(_count(least_chars), PARTIAL).groupBy("h", "f").agg(F.sum("n").alias("n"), F.max("doc").alias("doc"))
    members = written(counts.where(F.col("n") >= least), "common-lines")
    shards = -(-members.count() // shard_keys) or 1
    sharded = members.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    arrays = written(sharded.groupBy("shard").applyInArrow(_shard, SHARD), "line-arrays")
    names = [c.split(" ")[0] for c in SHARD.split(", ")]
    size = arrays.agg(F.sum(sum(F.octet_length(c) for c in names[2:]))).first()[0] or 0
    if size <= most_bytes:
        shared = docs.sparkSession.sparkContext.broadcast(arrays.toArrow().to_pylist())
        return rows.mapInArrow(_probing(shared, shards, least, least_chars), OUT)
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    rows = rows.withColumn("rid", F.unhex(F.md5(named.cast("binary"))))
    hits = _routed_hits(rows, arrays, shards, least, least_chars, slot_rows)
    gone = hits.groupBy("rid").agg(F.collect_set(F.struct("h", "f")).alias("gone"))
    return rows.join(gone, "rid", "left").mapInArrow(_listed(least_chars), OUT)
