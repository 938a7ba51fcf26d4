import math
import random
from collections import Counter

import numpy as np
import pytest
import regex

from stridecast.llm import ranked_search

DOCS, ITEMS = "doc_id long, text string, score long, rank string", "item_id long, text string, doc_id string"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in regex.findall(TERM, text or "")]


def _plain(docs, items, top=50):
    tfs = [(doc, Counter(_terms(text))) for doc, text, *_ in docs]
    tfs = [(doc, tf) for doc, tf in tfs if tf]
    big_n, big_l = len(tfs), sum(sum(tf.values()) for _, tf in tfs)
    df = Counter(t for _, tf in tfs for t in tf)
    out = []
    for item, text in {(i, t) for i, t, *_ in items}:
        scores = []
        for doc, tf in tfs:
            m = 100 - 50 + (50 * sum(tf.values()) * big_n) // big_l
            score = 0
            for t in set(_terms(text)):
                if t in tf:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0, doc))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def _tables():
    rng = random.Random(6)
    words = ["the", "of", "Straße", "É1", "日本", "x_y", "A1b2"] + [f"w{i}" for i in range(150)]
    weights = [60, 40, 20, 10, 5, 5, 5] + [3] * 40 + [1] * 110

    def text(k):
        return "".join(w + rng.choice([" ", ", ", "_", "\n", "\x7f"]) for w in rng.choices(words, weights, k=k))

    docs = [(3 * i % 1000, text(rng.randrange(40)), i, "clash") for i in range(700)]
    copy = text(30)
    docs += [(2000 + i, copy, 0, "") for i in range(300)] + [(None, copy, 0, ""), (None, text(9), 0, ""), (77, copy, 0, ""), (77, copy, 0, "")]
    docs += [(5000, None, 0, ""), (5001, "", 0, ""), (5002, " _ ", 0, ""), (5003, text(30_000), 0, "")]
    items = [(i, text(rng.randrange(1, 60)), "clash") for i in range(25)]
    items += [(100, copy, ""), (100, copy, ""), (100, "the", ""), (None, "w3 w4", ""), (101, None, ""), (102, "", ""), (103, "unknown", "")]
    return docs, items + [(104, "W1 w1 THE " * 3, "")]


@pytest.mark.parametrize("way", [{}, {"most_docs": 64}, {"most_entries": 100}, {"most_terms": 20}, {"most_items": 5, "top": 3}])
def test_ranks_equal_brute_force(spark, way):
    docs, items = _tables()
    found = ranked_search.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), **way)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == _plain(docs, items, way.get("top", 50))


def _tree(leaf, seed=1):
    rng = np.random.default_rng(seed)
    vectors = [np.unique(rng.geometric(0.1, rng.integers(1, 12)) % 40) for _ in range(900)] + [np.array([1, 4, 9])] * 200
    tf, m = rng.integers(1, 9, sum(map(len, vectors))), rng.integers(50, 300, len(vectors))
    at = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    return ranked_search.Tree(np.concatenate(vectors), tf, at, m, 40, leaf), vectors, tf, at, m


@pytest.mark.parametrize("leaf", [1, 8, 2000])
def test_no_document_scores_more_than_its_subtrees_allow(leaf):
    tree, vectors, tf, at, m = _tree(leaf)
    weights = np.zeros(40, np.int64)
    ranks = np.array([0, 1, 4, 7, 30])
    weights[ranks] = [3, 500, 40, 900, 7000]
    bounds = tree.bounds(ranks, weights)
    plain = [int((weights[v] * ranked_search._impact(tf[a:b], m[i])).sum()) for i, (v, a, b) in enumerate(zip(vectors, at, at[1:], strict=False))]
    for node in range(len(tree.begin)):
        own = tree.order[tree.begin[node] : tree.end[node]]
        assert bounds[node] >= max(plain[i] for i in own)
        if not tree.children[node]:
            assert tree.scores(node, weights).tolist() == [plain[i] for i in own]
        else:
            spans = [(tree.begin[k], tree.end[k]) for k in tree.children[node]]
            assert [spans[0][0], *(b for _, b in spans)] == [tree.begin[node], *(a for a, _ in spans[1:]), tree.end[node]]


def test_subtrees_are_left_out(monkeypatch):
    tree, *_ = _tree(8)
    entered = []
    plain = ranked_search.Tree.scores
    monkeypatch.setattr(ranked_search.Tree, "scores", lambda self, node, w: entered.append(node) or plain(self, node, w))
    weights = np.zeros(40, np.int64)
    weights[[1, 30]] = [10, 5000]
    best = ranked_search.Best.none(5)
    best.doc, best.has = np.arange(1100), np.ones(1100, bool)
    tree.search(np.array([1, 30]), weights, best)
    assert 0 < len(entered) < sum(not c for c in tree.children) / 2
    entered_all = [(-int(s), int(tree.order[tree.begin[k] + i])) for k in range(len(tree.begin)) if not tree.children[k] for i, s in enumerate(plain(tree, k, weights))]
    assert [(-int(s), int(d)) for s, d in zip(best.score, best.kept, strict=True)] == sorted(entered_all)[:5]


def test_empty_tables(spark):
    docs, items = _tables()
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert ranked_search.search(no_docs, spark.createDataFrame(items, ITEMS)).collect() == []
    assert ranked_search.search(spark.createDataFrame(docs[:5], DOCS), no_items).collect() == []
    assert ranked_search.search(no_docs, no_items).columns == ["item_id", "rank", "doc_id", "score"]
