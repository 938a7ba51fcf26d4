"""SimHash near-duplicates, found by Golay-code keys.

A fingerprint of 64 bits is cut into three segments. Of at most four differing
bits, spread over the segments, either a segment has none and another at most
two, or two segments have one each and the third at most two. In the first case
the documents share the exact bits of one segment and a nearby codeword of
another; in the second an exact half of each of two segments and a nearby
codeword of the third. Every fingerprint is filed under all such keys; those
that meet under a key are compared bit by bit.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm import golay
from stridecast.llm.components import components
from stridecast.llm.text import pieces_of, text_key
from stridecast.operators.quantiles import join_same
from stridecast.scratch import written

#: Bit position and length of the segments, and of their halves.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HALVES = (((0, 11), (11, 11)), ((22, 11), (33, 10)), ((43, 11), (54, 10)))
MOST_BITS = 4
#: A key with more fingerprints than this is cut again by the keys of permuted bits.
LARGE = 4096


def _fingerprint(text: str | None, size: int) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[size - 1 :] or ends[-1:]
    hashes = np.array([xxh64_intdigest(joined[a : b - 1], 42) for a, b in zip(starts, last, strict=False)], np.uint64)
    votes = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[a : a + (1 << 14)].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp (the 64 bits as a bigint) of every row; null texts are empty and have fingerprint 0."""

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_printed(shingle, ["doc_id"]), "doc_id bigint, fp bigint")


def _printed(shingle: int, kept: list[str]):
    """The columns ``kept`` and fp."""

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                found = [_fingerprint(t, shingle) for t in part.column("text").to_pylist()]
                yield pa.record_batch([*(part.column(c) for c in kept), pa.array(found, pa.int64())], [*kept, "fp"])

    return run


def _bits(values: np.ndarray, place: tuple[int, int]) -> np.ndarray:
    return ((values >> np.uint64(place[0])) & np.uint64((1 << place[1]) - 1)).astype(np.int64)


def key_families(values: np.ndarray):
    """For each kind of key: an array of keys, up to six for each fingerprint (-1: none)."""
    near = [golay.indices(_bits(values, s)) for s in SEGMENTS]
    kind = 0
    for a in range(3):
        exact = _bits(values, SEGMENTS[a])
        for b in range(3):
            if a != b:
                yield np.where(near[b] >= 0, (kind << 40) | (exact[:, None] << 12) | near[b], -1)
                kind += 1
    for c in range(3):
        a, b = (x for x in range(3) if x != c)
        for half in HALVES[a]:
            for other in HALVES[b]:
                exact = (_bits(values, half) << 11) | _bits(values, other)
                yield np.where(near[c] >= 0, (kind << 40) | (exact[:, None] << 12) | near[c], -1)
                kind += 1


def _keys(batches):
    for batch in batches:
        for begin in range(0, batch.num_rows, 4096):
            fps = batch.column("fp").slice(begin, 4096).to_numpy(zero_copy_only=False)
            for keys in key_families(fps.view(np.uint64)):
                row, column = np.nonzero(keys >= 0)
                yield pa.record_batch([pa.array(keys[row, column]), pa.array(fps[row])], ["key", "fp"])


def _permuted(values: np.ndarray, level: int) -> np.ndarray:
    order = np.random.default_rng(level).permutation(64)
    out = np.zeros_like(values)
    for to, at in enumerate(order.tolist()):
        out |= ((values >> np.uint64(at)) & np.uint64(1)) << np.uint64(to)
    return out


def spanning_links(values: np.ndarray, most: int, level: int = 0) -> list[tuple[int, int]]:
    """Index pairs within ``most`` bits that connect whatever such pairs connect, at most len - 1 in a small group.

    A large group is cut by the keys of permuted bits, under which close ones meet again.
    """
    n = len(values)
    links: list[tuple[int, int]] = []
    if n > LARGE and level < 6 and most <= MOST_BITS:
        for keys in key_families(_permuted(values, level + 1)):
            flat = keys.ravel()
            owner = np.repeat(np.arange(n), keys.shape[1])
            order = np.argsort(flat, kind="stable")
            order = order[flat[order] >= 0]
            cuts = np.flatnonzero(np.diff(flat[order])) + 1
            for group in np.split(owner[order], cuts):
                if 1 < len(group) < n:
                    links += [(group[i], group[j]) for i, j in spanning_links(values[group], most, level + 1)]
                elif len(group) == n:
                    links += spanning_links(values, most, 6)
        return links
    label = np.arange(n)
    for hub in range(n):
        if hub and (label == label[0]).all():
            break
        close = np.flatnonzero((np.bitwise_count(values ^ values[hub]) <= most) & (label != label[hub]))
        if len(close):
            found, first = np.unique(label[close], return_index=True)
            links += [(hub, int(close[i])) for i in first]
            label[np.isin(label, found)] = label[hub]
    return links


def _links(most: int):
    """Links between fingerprints under the same key; the rows come sorted by key."""

    def run(batches):
        left_key, left_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        above: dict[int, int] = {}  # what this task has joined already

        def top(x: int) -> int:
            while (up := above.setdefault(x, x)) != x:
                above[x] = x = above[up]
            return x

        def joined(keys, fps):
            out = []
            cuts = np.flatnonzero(np.diff(keys)) + 1
            begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            for a, b in zip(begin, end, strict=True):
                if b - a > 1:
                    group = np.unique(fps[a:b])
                    for i, j in spanning_links(group.view(np.uint64), most):
                        x, y = top(int(group[i])), top(int(group[j]))
                        if x != y:
                            above[x] = y
                            out.append((int(group[i]), int(group[j])))
            if len(above) > 1_000_000:
                above.clear()
            return out

        def table(out):
            a, b = zip(*out, strict=True)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([left_key, batch.column("key").to_numpy(zero_copy_only=False)])
            fps = np.concatenate([left_fp, batch.column("fp").to_numpy(zero_copy_only=False)])
            if not len(keys):
                continue
            whole = int(np.searchsorted(keys, keys[-1], "left"))  # the last key may go on
            left_key, left_fp = keys[whole:], fps[whole:]
            single = np.concatenate([[True], np.diff(keys[:whole]) != 0]) & np.concatenate([np.diff(keys[:whole]) != 0, [True]]) if whole else np.zeros(0, bool)
            if whole and not single.all() and (out := joined(keys[:whole][~single], fps[:whole][~single])):
                yield table(out)
        if len(left_key) > 1 and (out := joined(left_key, left_fp)):
            yield table(out)

    return run


def group_fingerprints(found: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """doc_id, fp, component_id from a table doc_id, fp.

    Fingerprints that differ in at most ``most`` (4 at most) bits are linked;
    ``component_id`` is the smallest id that links reach, the document's own included.
    Only distinct fingerprints are filed and compared, so copies cost one row.
    """
    named = _components(found.groupBy("fp").agg(F.min("doc_id").alias("least")), most)
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(named.join(roots, "component").select("fp", "component_id"), "fp")


def _components(distinct: DataFrame, most: int) -> DataFrame:
    """fp, least and component of the distinct fingerprints ``distinct`` (fp, least)."""
    if not 0 <= most <= MOST_BITS:
        raise ValueError(f"the keys are made for 0 to {MOST_BITS} differing bits")
    filed = distinct.select("fp").mapInArrow(_keys, "key bigint, fp bigint")
    links = filed.repartition("key").sortWithinPartitions("key").mapInArrow(_links(most), "a bigint, b bigint")
    place = components(links)
    named = distinct.join(place, distinct["fp"] == place["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    return written(named, "fingerprints")


def representatives(docs: DataFrame, shingle: int = 4, most: int = MOST_BITS) -> DataFrame:
    """doc_id, key (of the text) and copies (rows with both) for each group of near-duplicates, grouped as by ``near_duplicates``.

    It is the row with the smallest id, and of those that share it or have none the one with the smallest key;
    a row without an id only stands for a group in which none has one.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text"))
    found = written(rows.mapInArrow(_printed(shingle, ["doc_id", "key"]), "doc_id bigint, key string, fp bigint"), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    named = _components(found.groupBy("fp").agg(F.min(first).alias("least")), most)
    first = written(named.groupBy("component").agg(F.min("least").alias("least")).select("least.doc_id", "least.key"), "firsts")
    copies = found.groupBy("doc_id", "key").agg(F.count("*").alias("copies"))
    return join_same(copies, first, ["doc_id", "key"], "left_semi")


def first_rows(docs: DataFrame, shingle: int = 4, most: int = MOST_BITS) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: that of ``representatives``.

    Rows that repeat an id and text are one document. Of these the row is kept whose other columns come first
    in order, so the choice is the same on every run. Only such rows are gathered, partial minima first.
    """
    kept = written(representatives(docs, shingle, most), "representatives")
    keyed = docs.withColumn("_key", text_key(docs["text"].cast("string")))
    kept = kept.select("doc_id", F.col("key").alias("_key"), "copies")
    single = join_same(keyed, kept.where("copies = 1"), ["doc_id", "_key"], "left_semi").drop("_key")
    many = join_same(keyed, kept.where("copies > 1"), ["doc_id", "_key"], "left_semi")
    least = many.groupBy("doc_id", "_key").agg(F.min(F.struct(*[c for c in docs.columns if c != "doc_id"])).alias("_row"))
    return single.unionByName(least.select("doc_id", "_row.*").select(*docs.columns))


def near_duplicates(docs: DataFrame, shingle: int = 4, most: int = MOST_BITS) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and into shingles of ``shingle``
    words; a shorter text is one shingle. Null and empty texts have fingerprint 0 and are
    linked like any other. Rows that repeat an id are each a row. Rows with a null id get
    the smallest id of their group, null if it has none. Other columns are not read. An empty table gives no rows.
    """
    return group_fingerprints(written(fingerprints(docs, shingle), "simhash"), most)
