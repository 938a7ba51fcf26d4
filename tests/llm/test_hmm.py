import math
import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridecast.llm import hmm

SCHEMA = "doc_id long, text string, w string"


def learn():
    return F.col("doc_id") % 5 != 1


def _model(rng, symbols, states):
    emit = rng.random((symbols, states)) + 0.05
    move = rng.random((states, states)) + 0.05
    start = rng.random(states) + 0.05
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _paths(model, text):
    """Probability of every path."""
    for path in product(range(len(model.start)), repeat=len(text)):
        p = model.start[path[0]] * model.emit[text[0], path[0]]
        for a, b, x in zip(path, path[1:], text[1:], strict=False):
            p *= model.move[a, b] * model.emit[x, b]
        yield path, p


def test_forward_recursion_sums_over_all_paths():
    rng = np.random.default_rng(1)
    model = _model(rng, 5, 3)
    texts = [rng.integers(0, 5, n) for n in (4, 1, 7, 2, 7)]
    expected = [math.log10(sum(p for _, p in _paths(model, t))) for t in texts]
    assert hmm.log_likelihoods(model, texts) == pytest.approx(expected)
    long = rng.integers(0, 5, 5000)
    assert np.isfinite(hmm.log_likelihoods(model, [long])).all()


def test_expected_counts_equal_sums_over_all_paths():
    rng = np.random.default_rng(2)
    model = _model(rng, 4, 2)
    texts = sorted((rng.integers(0, 4, n) for n in (5, 3, 3, 1)), key=len, reverse=True)
    emitted, moved, started = np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2)
    hmm.expected_counts(model, texts, emitted, moved, started)
    want_emitted, want_moved, want_started = np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2)
    for text in texts:
        paths = list(_paths(model, text))
        total = sum(p for _, p in paths)
        for path, p in paths:
            want_started[path[0]] += p / total
            for state, x in zip(path, text, strict=True):
                want_emitted[x, state] += p / total
            for a, b in zip(path, path[1:], strict=False):
                want_moved[a, b] += p / total
    assert emitted == pytest.approx(want_emitted, rel=1e-4)
    assert moved == pytest.approx(want_moved, rel=1e-4)
    assert started == pytest.approx(want_started, rel=1e-4)


def _rows(n):
    rng = random.Random(4)
    langs = [[f"{p}{i}" for i in range(80)] for p in ("a", "bé", "c")]
    return [(i, " \n".join(rng.choices(rng.choice(langs), k=rng.randrange(1, 80))), "x") for i in range(n)]


@pytest.mark.parametrize(("top", "own"), [(1 << 18, 8192), (40, 10)])
def test_counts_equal_brute_force(spark, top, own):
    rows = _rows(120) + [(200, None, "x"), (201, "", "x"), (202, "The THE the É", "x"), (203, "new " * 3000, "x"), (206, "unseen A1", "x"), (206, "unseen A1", "x"), (None, "a1", "x")]
    found = hmm.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), learn(), rounds=2, top=top, own=own).collect()
    assert len(found) == len(rows)
    low = {c: c + 32 for c in range(65, 91)}
    cut = [(d, [w for w in (t or "").translate(low).split()] + [None]) for d, t, _ in rows]
    counts = Counter(w for d, words in cut if d is None or d % 5 != 1 for w in words)
    total, distinct = sum(counts.values()), len(counts)
    by_id = {d: words for d, words in cut}
    for row in found:
        words = by_id[row["doc_id"]]
        assert row["learn"] == (row["doc_id"] is None or row["doc_id"] % 5 != 1)
        assert (row["n_tokens"], row["train_tokens"]) == (len(words), total)
        assert row["n_known"] == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert row["base_score"] == pytest.approx(base, abs=1e-6)
        assert row["score"] < 0


def test_the_model_beats_word_counts_on_held_out_texts(spark):
    found = hmm.score_texts(spark.createDataFrame(_rows(400), SCHEMA), learn(), rounds=6).where("NOT learn").collect()
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found) * 0.95


def test_the_model_is_a_distribution(spark):
    """Probabilities of all one-word texts, unknown words of all classes included, sum to that of the length."""
    docs = spark.createDataFrame(_rows(30), SCHEMA)
    rows = docs.select(F.lit(0).alias("rid"), "doc_id", F.lit(True).alias("learn"), "text")
    vocab, counts = hmm.vocabulary(rows, 50, 20)
    assert vocab.frequency.sum() == vocab.total
    shares = np.zeros(hmm.CLASSES)
    own = set(vocab.words[vocab.symbols < vocab.own].tolist())
    for row in counts.collect():
        if row["w"] not in own:
            shares[row["w"] % hmm.CLASSES] += row["c"] + 0.5
    assert (shares + 0.5) / vocab.class_total == pytest.approx(np.ones(hmm.CLASSES))
    model = hmm._first_model(vocab, 3)
    assert model.emit.sum(axis=0) == pytest.approx(np.ones(3))


def test_nothing_to_learn_from(spark):
    assert hmm.score_texts(spark.createDataFrame([], SCHEMA), learn()).count() == 0
    row = hmm.score_texts(spark.createDataFrame([(1, "a b", "")], SCHEMA), learn()).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["learn"]) == (3, 0, 0, False)
    assert row["base_score"] == pytest.approx(0.0)


def test_most_frequent_words_are_exact(spark):
    rng = random.Random(3)
    for spread in (lambda: 1, lambda: rng.choice([1, 2, 3]), lambda: int(rng.paretovariate(0.4)), lambda: rng.randrange(1 << 40, 1 << 41)):
        rows = [(rng.randrange(-(1 << 63), 1 << 63), spread()) for _ in range(600)]
        counts = spark.createDataFrame(rows, "w long, c long").repartition(5)
        for top in (1, 7, 300, 599, 600, 900):
            expected = sorted(rows, key=lambda r: (-r[1], r[0]))[:top]
            found = hmm.most_frequent(counts, top)
            assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert hmm.most_frequent(spark.createDataFrame([], "w long, c long"), 5).collect() == []
