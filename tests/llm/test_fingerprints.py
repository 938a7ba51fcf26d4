import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from stridecast.llm import fingerprints
from stridecast.scratch import written

SCHEMA = "doc_id long, text string, block string"


def _print(text):
    votes, total = [0] * 64, 0
    for word in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()):
        if word:
            weight = max(min(len(word), 255) - 3, 1)
            h = xxhash.xxh64_intdigest(word.encode(), seed=42)
            total += weight
            for j in range(64):
                votes[j] += weight * (h >> j & 1)
    return sum(1 << j for j in range(64) if 2 * votes[j] > total)


def _expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text, *_) in enumerate(order):
        text, following = text or "", order[i - 1][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), _print(text), _print(edited), _print(following)))
    return out


def _found(docs, **options):
    found = fingerprints.with_edits(docs, **options)
    names = ["fp", "edited_fp", "next_fp"]
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], *(r[n] % (1 << 64) for n in names)) for r in found.collect()]


@pytest.mark.parametrize("size", [1, 2, 50])
def test_equal_to_brute_force(spark, size):
    rng = random.Random(size)
    words = ["the", "Straße", "ÉTÉ", "🙂🙂", "internationalization", "x" * 400, "of"]
    rows = [(rng.randrange(-5000, 5000), " ".join(rng.choices(words, k=rng.choice([0, 1, 9, 90]))), "clash") for _ in range(size)]
    if size > 10:
        rows += [(7, None, "a"), (7, "", "b"), (7, "again", "c"), (7, "again", "c"), (None, "no id", "d"), (8, " \n\t", "e"), (9, "lang " * 9000, "f")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for options in ({}, {"rows_per_block": 7}):
        assert sorted(_found(docs, **options), key=str) == sorted(_expected(rows), key=str)


def test_no_rows(spark):
    assert fingerprints.with_edits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_edited_texts_are_nearer_than_strangers(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 11))) for _ in range(150)), "") for i in range(60)]
    found = [(bin(r[3] ^ r[4]).count("1"), bin(r[3] ^ r[5]).count("1")) for r in _found(spark.createDataFrame(rows, SCHEMA))]
    assert sum(a < b for a, b in found) >= 55


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(300):
        value = rng.choice(values)
        for i in rng.sample(range(64), rng.randrange(1, 4)):
            value ^= 1 << i
        values.append(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(i, v) for i, v in enumerate(signed * 2)], "doc_id long, fp long")
    found = {(r["fp"], r["near_fp"], r["distance"]) for r in fingerprints.within_radius(prints, prints.where("doc_id % 5 = 0"), 3).collect()}
    asked = {v for i, v in enumerate(signed * 2) if i % 5 == 0}
    expected = {(a, b, d) for a in asked for b in set(signed) if (d := ((a ^ b) % (1 << 64)).bit_count()) <= 3}
    assert found == expected


def test_hot_ids_and_hot_texts(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "COPIES", 8)
    rng = random.Random(9)
    rows = [(None, f"{i:03} " + " ".join(rng.choices(["alpha", "beta", "gamma"], k=12)), "x") for i in range(60)]
    rows += [(None, "the same words again", "x")] * 35 + [(4, "the same words again", "x")] * 20 + [(5, None, "x")] * 9
    rows += [(-(1 << 63), "least id", "x"), (0, "zero", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for options in ({}, {"rows_per_block": 5}):
        assert sorted(_found(docs, **options), key=str) == sorted(_expected(rows), key=str)


def test_near_rows_are_all_counted(spark):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=8)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=120)) for _ in range(20)]
    rows = [(i, rng.choice(texts) + (" " + rng.choice(words)) * rng.randrange(3), "x") for i in range(400)]
    rows += [(None, texts[0], "x")] * 150 + [(50, "", "x"), (100, None, "x"), (1001, "", "x")]
    found = written(fingerprints.with_edits(spark.createDataFrame(rows, SCHEMA)), "test")
    seen = fingerprints.with_near(found, F.col("doc_id") % 50 == 0).collect()
    assert len(seen) == len(rows)
    got = [(r["doc_id"], r["fp"], r["n_near"]) for r in seen if r["doc_id"] is not None]
    prints = [_print(text) for _, text, _ in rows]
    expected = []
    for (doc, *_), mine in zip(rows, prints):
        if doc is not None:
            near = sum((mine ^ p).bit_count() <= 3 for p in prints) - 1 if doc % 50 == 0 else None
            expected.append((doc, mine - (1 << 64) if mine >> 63 else mine, near))
    assert sorted(got, key=str) == sorted(expected, key=str)
