import random

import numpy as np
import pytest

from stridecast.llm import decontamination as dec

DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string, words string"


def test_common_subsequence_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y and x else max(table[i][j + 1], table[i + 1][j])
        assert dec.common_subsequence(a, dec._places(np.array(b, int)), len(b)) == table[-1][-1]


def _word(rng):
    return "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(4, 9)))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    common = ["the", "of", "and", "to", "in"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else _word(rng) for _ in range(n)]

    items = [(i, " ".join(prose(rng.randrange(18, 60))) + ". " + " ".join(prose(6)) + ".") for i in range(30)]
    rows, planted = [], set()
    for doc in range(400):
        words = prose(rng.choice([5, 60, 300, 900]))
        if doc % 8 == 0:
            item, body = rng.choice(items)
            body = body.upper().split(" ")
            if doc % 16 == 0:  # a paraphrase: a word in nine is another, one is left out
                for i in range(0, len(body) - 7, 9):
                    body[i] = _word(rng)
                del body[10]
            place = rng.randrange(len(words) + 1)
            words[place:place] = body
            planted.add((doc, item))
        rows.append((doc, " \n".join(words), "clash"))
    return rows, [(i, t, "clash") for i, t in items], planted


def test_planted_passages_are_found_and_others_left(spark, corpus):
    rows, items, planted = corpus
    found = dec.benchmark_matches(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert len(found) == len(planted)
    exact = [r for r in found if r["doc_id"] % 16]
    assert all(r["common"] == 1.0 and r["answer"] == 1.0 for r in exact)
    texts = dict(r[:2] for r in rows)
    body = dict(r[:2] for r in items)
    for r in exact:
        cut = texts[r["doc_id"]].split()[r["start_word"] :]
        assert " ".join(cut).lower().startswith(body[r["item_id"]].lower())


def test_blocks_of_items_find_the_same(spark, corpus, monkeypatch):
    rows, items, planted = corpus
    monkeypatch.setattr(dec, "ITEMS", 11)
    found = dec.benchmark_matches(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == planted


def test_documents_with_passages_go(spark, corpus):
    rows, items, planted = corpus
    docs = spark.createDataFrame([*rows, (None, "x", "y"), (900, None, "y"), (901, "", "y"), (902, "w " * 20_000, "y")], DOCS)
    kept = dec.without_benchmark(docs, spark.createDataFrame([*items, (77, None, ""), (78, " ...", "")], ITEMS))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in planted} | {None, 900, 901, 902}


def test_repeated_rows_and_nothing(spark, corpus):
    rows, items, _ = corpus
    none, docs, all_items = spark.createDataFrame([], DOCS), spark.createDataFrame(rows[:9] * 2, DOCS), spark.createDataFrame(items, ITEMS)
    assert dec.benchmark_matches(none, all_items).count() == 0
    assert dec.benchmark_matches(docs, spark.createDataFrame([], ITEMS)).count() == 0
    found = sorted(tuple(r)[:2] for r in dec.benchmark_matches(docs, all_items).collect())
    assert found[::2] == found[1::2] and {d for d, _ in found} == {0, 8}, found


def test_an_item_that_a_third_of_the_documents_copy_in_part_is_found(spark):
    rng = random.Random(5)
    items = [(i, " ".join(_word(rng) for _ in range(40)), "") for i in range(20)]
    part = items[7][1].split(" ")[:34]
    rows = []
    for doc in range(900):
        words = [_word(rng) for _ in range(300)]
        if doc % 3 == 0:
            place = rng.randrange(len(words))
            words[place:place] = part
        rows.append((doc, " ".join(words), ""))
    found = dec.benchmark_matches(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(d, 7) for d in range(0, 900, 3)}
    assert all(r["common"] == 0.85 and r["run"] == 34 for r in found)


@pytest.mark.parametrize("halves", [512, 100])
def test_short_runs_of_long_items_are_found(spark, halves, monkeypatch):
    monkeypatch.setattr(dec, "ITEM_HALVES", halves, raising=False)
    rng = random.Random(6)
    items = [(i, " ".join(_word(rng) for _ in range(500)), "") for i in range(32)]
    rows, planted = [], set()
    for doc in range(128):
        words = [_word(rng) for _ in range(200)]
        item, body, _ = items[doc % 32]
        start, place = rng.randrange(481), rng.randrange(201)
        words[place:place] = body.split(" ")[start : start + 20]
        rows.append((doc, " ".join(words), ""))
        planted.add((doc, item, 20))
    found = dec.benchmark_matches(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"], r["run"]) for r in found} == planted


def test_runs_of_common_words_are_found(spark):
    """Few different words in the run, all of them frequent, and an item that is mostly rare words."""
    rng = random.Random(7)
    common = ["to", "be", "or"]
    run = [rng.choice(common) for _ in range(18)]
    rare = [_word(rng) for _ in range(42)]
    items = [(0, " ".join(rare[:20] + run + rare[20:]), ""), (1, " ".join(_word(rng) for _ in range(30)), "")]
    rows = []
    for doc in range(300):
        words = [rng.choice([*common, _word(rng), _word(rng)]) for _ in range(200)]
        if doc % 10 == 0:
            words[90:108] = run
        rows.append((doc, " ".join(words), ""))
    found = dec.benchmark_matches(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(d, 0) for d in range(0, 300, 10)}
    assert all(r["run"] >= 18 for r in found)


def _paraphrases():
    """Items that share most of their words, and documents with copies in which words are replaced and left out: no run decides."""
    rng = random.Random(12)
    words = [_word(rng) for _ in range(700)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(24, 56))), "") for i in range(160)]
    rows = []
    for doc in range(500):
        text = [rng.choice(words) if rng.random() < 0.5 else _word(rng) for _ in range(rng.choice([30, 120, 400]))]
        if doc % 2 == 0:
            body = items[rng.randrange(160)][1].split(" ")
            body = [w if i % 9 else _word(rng) for i, w in enumerate(body) if i % 14 != 5]
            place = rng.randrange(len(text) + 1)
            text[place:place] = body
        rows.append((doc, " ".join(text), ""))
    return rows, items


def _exhaustive(rows, items, rules):
    """Every passage of every document against every passage of every item."""
    import pyarrow as pa

    block = dec._block([{"item_id": i, "text": t} for i, t, _ in items])
    words, at = dec.word_hashes(pa.array([t for _, t, _ in rows]))
    place = np.minimum(np.searchsorted(block.vocabulary, words), len(block.vocabulary) - 1)
    numbers = np.where(block.vocabulary[place] == words, place + 1, 0)
    weight = np.ones(len(block.vocabulary) + 1, np.float32)
    targets = [dec._target(x, a) for x, a in zip(block.items, block.answers, strict=True)]
    found = {}
    for (doc, *_), a, b in zip(rows, at[:-1], at[1:], strict=True):
        text = numbers[a:b]
        for item, target in zip(block.ids, targets, strict=True):
            if len(np.intersect1d(text[text > 0], target.words)) < rules.paraphrase * len(np.unique(target.words)) / 2:
                continue
            for near in range(-len(target.words), len(text), dec.HALF):
                _, common, run, answer = dec.check(text, target, weight, near)
                if common >= rules.common or run >= rules.run or (common >= rules.paraphrase and answer >= rules.answer):
                    found[doc, item] = max(found.get((doc, item), 0), run)
    return found


def test_paraphrases_are_retrieved_by_their_latent_vectors(spark, monkeypatch):
    rows, items = _paraphrases()
    docs, benchmark = spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(items, ITEMS)
    truth = _exhaustive(rows, items, dec.Rules())
    assert len(truth) > 200 and sum(run < dec.Rules().run for run in truth.values()) > 0.9 * len(truth)
    assert len(dec._passages([np.ones(len(t.split()), int) for _, t, _ in items]).document) > dec.RANK
    cosines = {(r["doc_id"], r["item_id"]): r["cosine"] for r in dec.benchmark_matches(docs, benchmark).collect()}
    assert set(cosines) <= set(truth) and len(cosines) >= 0.95 * len(truth), (len(cosines), len(truth))
    # The space decides: with other columns the same documents lie elsewhere, and with a stricter limit fewer are candidates.
    plain = dec._latent_basis
    strict = dec.benchmark_matches(docs, benchmark, dec.Rules(cosine=0.97)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in strict if r["run"] < 16} == {k for k, c in cosines.items() if c >= 0.97 and truth[k] < 16}
    monkeypatch.setattr(dec, "_latent_basis", lambda *given: np.roll(plain(*given), 7, axis=0))
    moved = {(r["doc_id"], r["item_id"]): r["cosine"] for r in dec.benchmark_matches(docs, benchmark).collect()}
    assert np.mean([abs(moved[k] - c) for k, c in cosines.items() if k in moved]) > 0.02


def test_words_that_stand_together_in_documents_are_near(spark, monkeypatch):
    """Two passages without a common word, whose words documents use side by side: far in TF-IDF, near in the latent space."""
    monkeypatch.setattr(dec, "RANK", 10)
    monkeypatch.setattr(dec, "ITEM_WEIGHT", 0.01)
    rng = np.random.default_rng(4)
    topics = np.arange(200).reshape(10, 20) + 1
    halves = [topics[k, :10] for k in range(10)] + [topics[k, 10:] for k in range(10)]
    block = dec.Block(list(range(20)), halves, [], np.arange(200, dtype=np.uint64))
    texts = [rng.choice(topics[i % 10], 64).astype("<u4") for i in range(300)]
    table = spark.createDataFrame([(i, None, bytearray(t.tobytes())) for i, t in enumerate(texts)], "doc_id long, key string, words binary")
    weight = np.ones(201, np.float32)
    weight[0] = 0

    def cosines(basis):
        p = dec._passages(halves)
        vectors, _ = dec._sums(p, dec._counts(p, np.arange(1, 9), 201), basis)
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
        return (vectors[:10] * vectors[10:]).sum(axis=1)

    near = cosines(dec._latent_basis(table, block, weight, np.arange(1, 9)))
    noise = np.linalg.qr(np.random.default_rng(8).normal(size=(201, 10)))[0].astype(np.float32)
    assert near.min() > 0.6 and abs(cosines(noise).mean()) < 0.3


def test_basis_equals_one_step_of_subspace_iteration(spark, monkeypatch):
    monkeypatch.setattr(dec, "RANK", 5)
    rng = np.random.default_rng(3)
    block = dec.Block([0, 1], [rng.integers(1, 40, 50), rng.integers(1, 40, 30)], [], np.arange(39, dtype=np.uint64))
    texts = [rng.integers(0, 40, n).astype("<u4") for n in (0, 5, 32, 33, 64, 200, 1000)]
    table = spark.createDataFrame([(i, None, bytearray(t.tobytes())) for i, t in enumerate(texts)], "doc_id long, key string, words binary").repartition(3)
    weight = np.concatenate([[0], rng.uniform(0.5, 2, 39)]).astype(np.float32)

    def matrix(values):
        out = []
        for v in values:
            for a in range(0, max(len(v), 1), dec.HALF):
                out.append(np.bincount(np.asarray(v[a : a + 2 * dec.HALF], int), minlength=40) * weight)
        return np.array(out)

    noise = np.random.default_rng(1).normal(size=(40, 5)).astype(np.float32)
    own, total = (m.T @ (m @ noise) for m in (matrix(block.items), matrix(texts)))
    expected = np.linalg.qr(total + dec.ITEM_WEIGHT * np.linalg.norm(total) / np.linalg.norm(own) * own)[0]
    for often in (np.array([3, 7, 20]), np.arange(1, 40)):
        basis = dec._latent_basis(table, block, weight, often)
        assert np.allclose(basis @ basis.T, expected @ expected.T, atol=1e-4)
