import random

import numpy as np
import pytest

from stridecast.llm import bwt, bytes_dedup, seeds, substring, text

SCHEMA = "doc_id long, text string, h string"


def test_window_minima_takes_the_leftmost():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 8, 13):
        values = rng.integers(0, 6, 200)
        expected = [i + int(np.argmin(values[i : i + width])) for i in range(200 - width + 1)]
        assert text.window_minima(values, width).tolist() == expected


def _plain_cuts(data, least):
    order = sorted(range(len(data)), key=lambda i: data[i:])
    cuts = [True]
    for a, b in zip(order, order[1:], strict=False):
        same = 0
        while same < least and max(a, b) + same < len(data) and data[a + same] == data[b + same]:
            same += 1
        cuts.append(same < least)
    return order, cuts


@pytest.mark.parametrize("letters", [1, 2, 4, 250])
@pytest.mark.parametrize("least", [1, 2, 5, 16])
def test_cuts_equal_plain_comparison(letters, least):
    rng = np.random.default_rng(letters * 100 + least)
    for size in (1, 2, 3, 30, 400):
        data = rng.integers(1, letters + 1, size)
        if size > 100:
            data[200:260] = data[20:80]
        order, cuts = _plain_cuts(data.tolist(), least)
        got_order, got = bwt.prefix_cuts(data, least)
        # Equal for ``least`` characters means any order; the groups must agree.
        groups = {}
        for row, group in zip(order, np.cumsum(cuts), strict=True):
            groups[row] = int(group)
        assert {int(r): int(g) for r, g in zip(got_order, np.cumsum(got), strict=True)} == groups


def _texts(rng, words, n=70):
    passages = [" ".join(rng.choices(words, k=rng.choice([15, 25, 60]))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(3)]
        for p in rng.choices(passages, k=rng.randrange(3)):
            cut = p.split(" ")
            if rng.random() < 0.4:
                cut[rng.randrange(len(cut))] = "edited"
            parts.insert(rng.randrange(4), " ".join(cut))
        texts.append(rng.choice([" ", "  ", "\n"]).join(parts))
    return texts + texts[:5] + ["", None, "ha " * 300, "x" * 3000, "ab" * 700 + "é" * 200, passages[2], " " + passages[2]]


def _plain_words(rows, window):
    seen, out = set(), {}
    for doc, body, *_ in sorted(rows):
        words = (body or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        out[doc] = (len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_words_equal_brute_force(spark, size, monkeypatch):
    rng = random.Random(11)
    texts = _texts(rng, ["the", "of", "Straße", "é", "x1", "y", "cat", "dog"] + [f"w{i}" for i in range(60)])
    rows = [(500 - 3 * i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["doc_id"]: tuple(r)[1:] for r in substring.without_repeats(docs).collect()}
    assert found == _plain_words([(d, (t or ""), 0) for d, t, _ in rows], 20)


def _plain_bytes(rows, window):
    times, out = {}, {}
    cut = [(d, (t or "").encode()) for d, t, *_ in rows]
    for _, data in cut:
        for i in range(len(data) - window + 1):
            times[data[i : i + window]] = times.get(data[i : i + window], 0) + 1
    for doc, data in cut:
        mask = np.zeros(len(data), bool)
        for i in range(len(data) - window + 1):
            if times[data[i : i + window]] > 1:
                mask[i : i + window] = True
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out[doc] = (len(data), int(mask.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~mask]))
    return out


@pytest.mark.parametrize("large", [256, 2])
def test_bytes_equal_brute_force(spark, large, monkeypatch):
    monkeypatch.setattr(bytes_dedup, "LARGE", large)
    monkeypatch.setattr(bytes_dedup, "JOINED", 3000)
    rng = random.Random(12)
    texts = _texts(rng, ["the", "of", "Straße", "é", "x1", "y"] + [f"w{i}" for i in range(30)], 50)
    rows = [(i * 5, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["doc_id"]: (*tuple(r)[1:4], bytes(r["kept"])) for r in bytes_dedup.without_repeats(docs).collect()}
    assert found == _plain_bytes(rows, 200)


def test_small_windows_meet_everywhere(spark):
    """Short windows over few letters: many anchors, many ties."""
    rng = random.Random(13)
    rows = [(i, "".join(rng.choices("ab", k=rng.randrange(60))), "") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r["doc_id"]: (*tuple(r)[1:4], bytes(r["kept"])) for r in bytes_dedup.without_repeats(docs, 12, 4).collect()}
    assert found == _plain_bytes(rows, 12)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randrange(60))), "") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r["doc_id"]: tuple(r)[1:] for r in substring.without_repeats(docs, 8, 3).collect()}
    assert found == _plain_words(rows, 8)


def test_repeated_rows_nulls_and_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring.without_repeats(empty).count() == bytes_dedup.without_repeats(empty).count() == 0
    body = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(3, body, ""), (3, body, ""), (None, body, ""), (None, None, "")], SCHEMA)
    found = sorted(tuple(r)[:3] for r in substring.without_repeats(docs.where("doc_id = 3")).collect())
    assert found == [(3, 60, 0)] * 2
    found = substring.without_repeats(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in found) == [("3", 60, 60)] * 2 + [("None", 0, 0), ("None", 60, 0)]
    found = [tuple(r)[1:4] for r in bytes_dedup.without_repeats(docs.where("doc_id = 3")).collect()]
    assert found == [(len(body), len(body), 1)] * 2


def test_packed_places():
    at = np.array([(123456 << 32) | (100 << 17) | (137 << 1) | 1])
    assert seeds.start_of(at).tolist() == [123456] and seeds.count_of(at).tolist() == [137]


def test_texts_without_an_id_of_their_own_equal_brute_force(spark):
    rng = random.Random(14)
    texts = sorted({t for t in _texts(rng, [f"w{i}" for i in range(60)], 40) if t})
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t, "") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ranked = docs.selectExpr("doc_id", "text", "row_number() OVER (ORDER BY doc_id NULLS FIRST, shiftrightunsigned(xxhash64(text), 1)) AS place")
    order = {(r["doc_id"], r["text"]): r["place"] for r in ranked.collect()}
    plain = _plain_words([(order[d, t], t) for d, t, _ in rows], 20)
    found = sorted(tuple(r) for r in substring.without_repeats(docs).collect() if r["doc_id"] is not None)
    assert found == sorted((d, *plain[order[d, t]]) for d, t, _ in rows if d is not None)
    found = sorted(tuple(r)[1:] for r in substring.without_repeats(docs).collect() if r["doc_id"] is None)
    assert found == sorted(plain[order[d, t]] for d, t, _ in rows if d is None)
    plain = _plain_bytes([(order[d, t], t) for d, t, _ in rows], 200)
    found = sorted((str(r["doc_id"]), *tuple(r)[1:4], bytes(r["kept"])) for r in bytes_dedup.without_repeats(docs).collect())
    assert found == sorted((str(d), *plain[order[d, t]]) for d, t, _ in rows)
