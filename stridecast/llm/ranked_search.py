"""Documents ranked for each item, by branch and bound over trees of frequency-ordered term vectors.

Items are taken in blocks with a bounded number of different terms. Documents are reduced to
vectors of a block's terms, the most frequent first. Each task sorts its vectors, so
those that begin alike share a path of a trie. A subtree knows the largest tf of every term below
it and the smallest m, and with them no document below can score more than its bound. Per
item the subtrees are entered depth first, the highest bound first, and left out if the bound
is under the score of the last of the best found so far. Scores are 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridecast.llm.text import RollingHash, bytes_of, pieces_of, words_of
from stridecast.scratch import empty_frame, written

_HASH = RollingHash(31)
#: Bytes outside terms (ASCII but digits and letters).
_OUTSIDE = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
VECTORS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
OUT = "item_id bigint, rank int, doc_id bigint, score bigint"
_LEAST = np.iinfo(np.int64).min


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term, and the number of terms before each text."""
    data, at = bytes_of(texts, lower=True)
    begin, end, before = words_of(data, at, _OUTSIDE)
    return _HASH.of(_HASH.prefix_bytes(data), begin, end).view(np.int64), before


def _items(batches):
    """Each item with its different terms."""
    for batch in batches:
        for part in pieces_of(batch, "text"):
            terms, at = _terms(part.column("text"))
            found = [np.unique(terms[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.record_batch([part.column("item_id"), pa.array(found, pa.list_(pa.int64()))], ["item_id", "terms"])


def _blocks(items: DataFrame, most_terms: int, most_items: int) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Items with at most so many different terms together, or one item with more."""
    block, seen = [], set()
    for row in items.toLocalIterator():
        together = seen.union(row.terms)
        if block and (len(together) > most_terms or len(block) >= most_items):
            yield block
            block, together = [], set(row.terms)
        block.append((row.item_id, np.array(row.terms, np.int64)))
        seen = together
    if block:
        yield block


def _vectors(vocabulary: np.ndarray):
    """All documents: the number of their terms, and which of the vocabulary they hold how often."""

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                terms, at = _terms(part.column("text"))
                place = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                known = vocabulary[place] == terms
                text = np.repeat(np.arange(len(at) - 1), np.diff(at))[known]
                pairs, tf = np.unique(text * len(vocabulary) + place[known], return_counts=True)
                edges = np.searchsorted(pairs, np.arange(len(at)) * len(vocabulary)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(edges, x.astype(np.int32)) for x in (pairs % len(vocabulary), tf)]
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(at)), *lists], ["doc_id", "n", "terms", "tfs"])

    return run


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score for one unit of weight: grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _largest(group: np.ndarray, rank: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest tf of each rank in each group."""
    order = np.lexsort((rank, group))
    group, rank, tf = group[order], rank[order], tf[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(group) != 0) | (np.diff(rank) != 0)]))
    return group[first], rank[first], np.maximum.reduceat(tf, first)


class Tree:
    """A trie of documents' terms by rank (the most frequent is 0), with bounds for every subtree.

    ``at``: entries before each document, one more; every document has entries, in the order of ranks.
    Subtrees with at most ``leaf`` documents end as leaves, small neighbours below one node together.
    """

    def __init__(self, rank: np.ndarray, tf: np.ndarray, at: np.ndarray, m: np.ndarray, ranks: int, leaf: int = 32):
        keys = [rank[a:b].astype(">u4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
        sizes = np.diff(at)[self.order]
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        entry = np.repeat(at[:-1][self.order] - self.at[:-1], sizes) + np.arange(self.at[-1])
        self.rank, tf, m = rank[entry], tf[entry], m[self.order]
        self.impact = _impact(tf, np.repeat(m, sizes))
        self.begin, self.end, self.children = [0], [len(keys)], []
        for node, a in enumerate(self.begin):  # grows while it runs: children follow their parents
            cuts = self._cuts(a, self.end[node], leaf)
            self.children.append(range(len(self.begin), len(self.begin) + len(cuts)))
            self.begin += [a for a, _ in cuts]
            self.end += [b for _, b in cuts]
        self._bound(tf, m, ranks)

    def _cuts(self, a: int, b: int, leaf: int) -> list[tuple[int, int]]:
        """Documents of the children of the node that holds a to b; none for a leaf."""
        if b - a <= leaf:
            return []
        one, two = (self.rank[self.at[i] : self.at[i + 1]] for i in (a, b - 1))
        most = min(len(one), len(two))
        differ = np.flatnonzero(one[:most] != two[:most])
        depth = int(differ[0]) if len(differ) else most
        if depth == len(one) == len(two):
            return []
        # Sorted: the shared path is that of the first and the last; what ends here comes first.
        place = self.at[a:b] + depth
        term = np.where(place < self.at[a + 1 : b + 1], self.rank[np.minimum(place, len(self.rank) - 1)].astype(np.int64), -1)
        edges = [a, *(np.flatnonzero(np.diff(term)) + a + 1).tolist(), b]
        out: list[tuple[int, int]] = []
        for x, y in zip(edges, edges[1:], strict=False):
            if out and y - out[-1][0] <= leaf:
                out[-1] = (out[-1][0], y)
            else:
                out.append((x, y))
        return out

    def _bound(self, tf: np.ndarray, m: np.ndarray, ranks: int) -> None:
        """By rank, the nodes below which it occurs and the most it can add there."""
        nodes = len(self.begin)
        least = np.array([m[a:b].min() for a, b in zip(self.begin, self.end, strict=True)])
        ends = np.array([not c for c in self.children])
        leaves = np.flatnonzero(ends)
        leaves = leaves[np.argsort(np.array(self.begin)[leaves])]
        owner = np.repeat(leaves, [self.at[self.end[k]] - self.at[self.begin[k]] for k in leaves.tolist()])
        found = _largest(owner, self.rank, tf)
        parts = np.split(np.stack(found[1:]), np.flatnonzero(np.diff(found[0])) + 1, axis=1)
        held = dict(zip(sorted(leaves.tolist()), parts, strict=True))
        for node in range(nodes - 1, -1, -1):
            if self.children[node]:
                below = np.concatenate([held[k] for k in self.children[node]], axis=1)
                held[node] = np.stack(_largest(np.zeros(below.shape[1], np.int8), *below)[1:])
        node = np.repeat(np.arange(nodes), [held[k].shape[1] for k in range(nodes)])
        rank, most = np.concatenate([held[k] for k in range(nodes)], axis=1)
        order = np.argsort(rank, kind="stable")
        self.of_rank = np.searchsorted(rank[order], np.arange(ranks + 1))
        self.nodes, self.most = node[order], _impact(most, least[node])[order]

    def bounds(self, ranks: np.ndarray, weights: np.ndarray) -> list[int]:
        out = np.zeros(len(self.begin), np.int64)
        for rank, weight in zip(ranks.tolist(), weights[ranks].tolist(), strict=True):
            own = slice(self.of_rank[rank], self.of_rank[rank + 1])
            out[self.nodes[own]] += weight * self.most[own]
        return out.tolist()

    def scores(self, node: int, weights: np.ndarray) -> np.ndarray:
        at = self.at[self.begin[node] : self.end[node] + 1]
        own = slice(at[0], at[-1])
        return np.add.reduceat(weights[self.rank[own]] * self.impact[own], at[:-1] - at[0])

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer all documents to ``best`` that can be among them. ``weights``: by rank, zero outside the item."""
        bounds = self.bounds(ranks, weights)
        stack = [0]
        while stack:
            node = stack.pop()
            if bounds[node] < best.least:
                continue
            if self.children[node]:
                stack += sorted((k for k in self.children[node] if bounds[k] >= best.least), key=bounds.__getitem__)
            else:
                scores = self.scores(node, weights)
                good = np.flatnonzero(scores >= best.least)
                if len(good):
                    best.offer(scores[good], self.order[self.begin[node] + good])


@dataclass
class Best:
    """The ``top`` highest scores of an item with their documents, those with the smallest ids of equals."""

    top: int
    doc: np.ndarray  # ids of the documents that are offered by number
    has: np.ndarray  # whether they have one
    score: np.ndarray
    kept: np.ndarray
    kept_has: np.ndarray
    least: int = 1

    @classmethod
    def none(cls, top: int) -> Best:
        empty = np.zeros(0, np.int64)
        return cls(top, empty, empty.astype(bool), empty, empty, empty.astype(bool))

    def offer(self, scores: np.ndarray, numbers: np.ndarray) -> None:
        score = np.concatenate([self.score, scores])
        doc = np.concatenate([self.kept, self.doc[numbers]])
        has = np.concatenate([self.kept_has, self.has[numbers]])
        order = np.lexsort((doc, has, -score))[: self.top]
        self.score, self.kept, self.kept_has = score[order], doc[order], has[order]
        if len(order) == self.top:
            self.least = int(self.score[-1])


def _trees(batches, rank_of: np.ndarray, total_docs: int, total_terms: int, most_docs: int, most_entries: int):
    """Trees of the documents with terms, with their ids."""

    def tree(parts):
        doc, has, m, sizes, rank, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
        return Tree(rank, tf, np.concatenate([[0], np.cumsum(sizes)]), m, len(rank_of)), doc, has

    held, docs, entries = [], 0, 0
    for batch in batches:
        column = batch.column("doc_id")
        doc, has = column.fill_null(_LEAST).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)
        n, at = batch.column("n").to_numpy(), batch.column("terms").offsets.to_numpy()
        m = 100 - 50 + (50 * n * total_docs) // max(total_terms, 1)
        sizes = np.diff(at)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rank = rank_of[batch.column("terms").flatten().to_numpy()]
        order = np.lexsort((rank, owner))
        rank, tf, at = rank[order], batch.column("tfs").flatten().to_numpy().astype(np.int64)[order], at - at[0]
        a = 0
        while a < len(sizes):
            b = int(np.searchsorted(at, at[a] + most_entries, "right")) - 1
            b = min(len(sizes), a + most_docs, max(b, a + 1))
            some = np.flatnonzero(sizes[a:b]) + a
            if len(some):
                held.append((doc[some], has[some], m[some], sizes[some], rank[at[a] : at[b]], tf[at[a] : at[b]]))
                docs, entries = docs + len(some), entries + int(at[b] - at[a])
                if docs >= most_docs or entries >= most_entries:
                    yield tree(held)
                    held, docs, entries = [], 0, 0
            a = b
    if held:
        yield tree(held)


def _searching(asked: list, weight: np.ndarray, rank_of: np.ndarray, totals: tuple[int, int], top: int, most_docs: int, most_entries: int):
    """Each task gives the best of its own documents for every item of the block."""

    def run(batches):
        best = [Best.none(top) for _ in asked]
        weights = np.zeros(len(rank_of), np.int64)
        for tree, doc, has in _trees(batches, rank_of, *totals, most_docs, most_entries):
            for (_, ranks), own in zip(asked, best, strict=True):
                own.doc, own.has = doc, has
                weights[ranks] = weight[ranks]
                tree.search(ranks, weights, own)
                weights[ranks] = 0
        for number, ((item_id, _), own) in enumerate(zip(asked, best, strict=True)):
            k = len(own.score)
            if k:
                columns = [
                    pa.array(np.full(k, number, np.int32)),
                    pa.array([item_id] * k, pa.int64()),
                    pa.array(own.kept, mask=~own.kept_has),
                    pa.array(own.score),
                ]
                yield pa.record_batch(columns, ["item", "item_id", "doc_id", "score"])

    return run


def _block(docs: DataFrame, block: list, top: int, most_docs: int, most_entries: int) -> DataFrame:
    vocabulary = np.unique(np.concatenate([terms for _, terms in block]))
    vectors = written(docs.mapInArrow(_vectors(vocabulary), VECTORS), "vectors")
    total_docs, total_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    # One row for each term of the block.
    counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df[counted.column("term").to_numpy()] = counted.column("count").to_numpy()
    by_rank = np.lexsort((np.arange(len(df)), -df))
    rank_of = np.empty(len(df), np.int64)
    rank_of[by_rank] = np.arange(len(df))
    weight = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * n + 1))) for n in df[by_rank].tolist()], np.int64)
    asked = [(item_id, np.sort(rank_of[np.searchsorted(vocabulary, terms)])) for item_id, terms in block]
    run = _searching(asked, weight, rank_of, (total_docs, total_terms), top, most_docs, most_entries)
    found = vectors.mapInArrow(run, "item int, item_id bigint, doc_id bigint, score bigint")
    # First the best of shares of an item's rows, then of what is left of them.
    order = (F.desc("score"), F.asc_nulls_first("doc_id"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(32))
    found = found.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order)))
    found = found.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return found.where(F.col("rank") <= top).select(*[c.split(" ")[0] for c in OUT.split(", ")])


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 50,
    most_terms: int = 1 << 16,
    most_items: int = 4096,
    most_docs: int = 1 << 14,
    most_entries: int = 1 << 21,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``top`` documents of each item with a score above 0.

    Terms are runs of ASCII digits, ASCII letters (in lower case) and all characters beyond ASCII, known by a 64-bit hash. A
    document's score sums w * ((10**9 * tf) div (1000 * tf + 20 * m)) over the item's different terms, with
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m = 50 + ((50 * n * N) div L). Equal scores come by ascending id.

    A null text has no terms; items without terms get no rows. Every row of ``docs`` is a document, a null id is smaller
    than all others. Rows of ``items`` that repeat id and text are one item, others with one id (or none) are items of
    their own. Other columns are not read. An empty table on either side gives no rows.
    Items are searched in blocks of ``most_items`` or ``most_terms`` different terms; each block reads the documents once.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    rows = written(rows.mapInArrow(_items, "item_id bigint, terms array<bigint>"), "items").where(F.size("terms") > 0)
    found = None
    for block in _blocks(rows, most_terms, most_items):
        ranked = written(_block(docs, block, top, most_docs, most_entries), "ranked")
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return empty_frame(docs.sparkSession, docs.sparkSession.createDataFrame([], OUT).schema)
    return found
