import random
import zlib
from collections import Counter
from itertools import combinations

import pytest
import regex

from stridecast.llm import spelling
from stridecast.llm.acceptor import Acceptor, near_pairs

SCHEMA = "doc_id long, text string, word string, n long"


def _near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def _plain_variants(counts):
    out = []
    near = {w: [] for w in counts}
    for x, y in combinations(sorted(counts), 2):
        if _near(x, y):
            near[x].append(y)
            near[y].append(x)
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= 2 * n else None
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, forms[word], root, n, len(near[word]), counts[forms[word]] if forms[word] else None))
    return sorted(out)


def _plain_words(rows):
    words = Counter()
    for doc, text, *_ in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def _shown(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("letters", ["a", "ab", "abcé"])
def test_pairs_equal_brute_force_each_once(letters):
    rng = random.Random(len(letters))
    for size in (1, 2, 10, 60):
        words = sorted({"".join(rng.choices(letters, k=rng.randrange(7))) for _ in range(size)})
        acceptor = Acceptor(words)
        found = [tuple(sorted(p)) for k in range(7) for p in near_pairs(acceptor, k, True)]
        assert len(found) == len(set(found))
        assert set(found) == {p for p in combinations(words, 2) if _near(*p)}
        shut = [tuple(sorted(p)) for k in range(7) for p in near_pairs(acceptor, k, False)]
        assert set(shut) <= set(found) and len(shut) == len(set(shut))


def test_acceptor_is_minimal():
    # All strings of three letters: one state a level.
    words = sorted(a + b + c for a in "xyz" for b in "xyz" for c in "xyz")
    assert len(Acceptor(words).arcs) == 4


@pytest.mark.parametrize("most", [20_000, 30, 2])
def test_variants_equal_brute_force(spark, most):
    rng = random.Random(8)
    counts = {}
    for _ in range(900):
        word = "".join(rng.choices("abé", k=rng.randrange(5, 10)))
        counts[word] = rng.choice([3, 4, 8, 9, 20, 50, 400, 10**12])
    counts |= {"x" * 3000: 4, "x" * 3001: 9, "x" * 1500 + "y" + "x" * 1499: 30, "y" + "x" * 2999: 30}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert _shown(spelling.variants(words, 5, most)) == _plain_variants(counts)


def test_documents_equal_brute_force(spark):
    rng = random.Random(4)
    base = ["Straße", "letters", "lettres", "ÉCOLE", "écoles", "école", "ÿÿÿÿÿ", "abcde", "tiny", "Öffnen", "ab×÷cd"]
    rows = []
    for i in range(300):
        text = rng.choice([" ", ", ", "1", "\n", "ă"]).join(rng.choices(base, k=rng.randrange(30)))
        rows.append((i * 13, text, "clash", i))
    rows += [(None, " ".join(base * 5), "", 0), (None, None, "", 0), (1, "", "", 0), (7, None, "", 0)]
    rows += [(9, "letters " * 400, "", 0)] * 3 + [(12, "school" * 5000 + " ", "", 0)] * 3 + [(13, "école " * 40_000, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = _plain_variants(_plain_words(rows))
    assert any(r[1] for r in expected)
    assert _shown(spelling.spelling_variants(docs)) == expected


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaaaaaa"[:i] + "b" * (9 - i): 3 * 2**i for i in range(9)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = _shown(spelling.variants(words))
    assert found == _plain_variants(counts) and {r[2] for r in found} == {"aaaaaaaab"}


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, None, "", 0), (2, "a b c", "", 0)], SCHEMA)
    assert spelling.spelling_variants(docs).collect() == []
