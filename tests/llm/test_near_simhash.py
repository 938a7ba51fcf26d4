import random

import numpy as np
import pytest
import xxhash

from stridecast.llm import golay, near_simhash
from stridecast.llm.components import components


def test_golay_words_two_bits_apart_share_a_codeword():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 3000)
    for i, j in rng.integers(0, 23, (40, 2)).tolist():
        other = words ^ (1 << i) ^ ((1 << j) if i != j else 0)
        a, b = golay.indices(words), golay.indices(other)
        shared = (a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)
        assert shared.any(axis=(1, 2)).all()


def _near(rng, value, bits):
    for i in rng.sample(range(64), bits):
        value ^= 1 << i
    return value


def test_close_fingerprints_share_a_key():
    rng = random.Random(4)
    a = [rng.getrandbits(64) for _ in range(4000)]
    b = [_near(rng, x, rng.randrange(5)) for x in a]
    kinds = zip(*(near_simhash.key_families(np.array(x, np.uint64)) for x in (a, b)), strict=True)
    met = np.zeros(len(a), bool)
    for x, y in kinds:
        met |= ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] >= 0)).any(axis=(1, 2))
    assert met.all()


def _classes(values, most=4):
    """Brute force: smallest index reachable."""
    label = list(range(len(values)))
    for i, x in enumerate(values):
        for j in range(i):
            if (x ^ values[j]).bit_count() <= most and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if k == high else k for k in label]
    return label


@pytest.mark.parametrize("large", [4096, 20])
def test_spanning_links_connect_what_links_connect(monkeypatch, large):
    monkeypatch.setattr(near_simhash, "LARGE", large)
    rng = random.Random(6)
    values = [rng.getrandbits(64) for _ in range(15)]
    for _ in range(150):
        values.append(_near(rng, rng.choice(values), rng.randrange(1, 7)))
    values = sorted(set(values))
    label = list(range(len(values)))
    for i, j in near_simhash.spanning_links(np.array(values, np.uint64), 4):
        assert (values[i] ^ values[j]).bit_count() <= 4
        low, high = sorted((label[i], label[j]))
        label = [low if k == high else k for k in label]
    assert label == _classes(values)


def _plain_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)] + ["ÄÖ", "ÀB", "xA"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 80, 200]))) for _ in range(60)]
    for _ in range(60):
        cut = rng.choice(texts).split(" ")
        cut[rng.randrange(len(cut))] = rng.choice(words)
        texts.append("\t".join(cut) + " ")
    texts += ["", None, " \n", "One two", "oNE  TWO", "a b " * 3000]
    rows = [(1000 - i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, fp string")
    found = near_simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows) + 1
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in found}
    ids = sorted(got)
    expected = [_plain_fingerprint(texts[1000 - i]) for i in ids]
    assert [got[i][0] for i in ids] == expected
    assert [got[i][1] for i in ids] == [ids[k] for k in _classes(expected)]


def test_no_documents_and_no_ids(spark):
    schema = "doc_id long, text string"
    assert near_simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    found = near_simhash.near_duplicates(spark.createDataFrame([(None, "a b"), (None, "c"), (5, "a b")], schema))
    assert sorted((r["component_id"] for r in found.collect()), key=str) == [5, 5, None]


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1001)]
    rng = random.Random(1)
    name = list(range(1002))
    rng.shuffle(name)
    links = spark.createDataFrame([(name[a] - 500, name[b] - 500) for a, b in chain], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert len(found) == 203
    assert len({found[name[i] - 500] for i in range(201)}) == 1
    assert len(set(found.values())) == 2
