import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stridecast.llm import lines
from stridecast.llm.perfect_hash import PerfectHash, build

SCHEMA = "doc_id long, text string, n long, kept string"
WHITE = " \t\n\v\f\r"


def _key(line):
    line = line.strip(WHITE)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def _plain(rows, least=3, least_chars=20):
    docs = defaultdict(set)
    for number, (doc, text, *_) in enumerate(rows):
        for line in (text or "").split("\n"):
            docs[_key(line)].add((doc is not None, doc or 0, number))
    out = []
    for doc, text, *_ in rows:
        all_lines = (text or "").split("\n")
        kept = []
        for line in all_lines:
            holders = docs[_key(line)]
            if len(_key(line)) < least_chars or len(holders) < least or max(holders)[:2] == (doc is not None, doc or 0):
                kept.append(line)
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def _rows():
    rng = random.Random(3)
    common = ["All rights reserved by the owners.", "ÉÉ subscribe to our newsletter é", "x" * 19, "y" * 20, "Ñ" * 20, "𝔘" * 10 + "ab" * 5]
    own = [f"A sentence of its own, number {i}" for i in range(200)]
    rows = []
    for i in range(120):
        chosen = [rng.choice(common + own) for _ in range(rng.randrange(12))]
        chosen = [rng.choice(["", " ", "\t\v", "\r"]) + (c.upper() if rng.random() < 0.3 and c.isascii() else c) + rng.choice(["", "  ", "\r"]) for c in chosen]
        rows.append((7 * i % 120, "\n".join(chosen), i, "clash"))
    rows += [(500, None, 0, None), (501, "", 0, None), (502, "\n\n", 0, None), (503, "\n", 0, None), (504, " ", 0, None)]
    rows += [(505, "\n".join([common[0]] * 3000 + ["end"] * 2000), 0, None)]
    rows += [(None, "only rows without an id hold this line\nand more", i, None) for i in range(4)]
    rows += [(None, common[0] + "\n" + own[3], 0, None), (600, common[1], 0, None), (600, common[1], 1, None), (600, own[5], 1, None)]
    return rows


def test_slots_are_minimal_and_perfect():
    for n in (1, 2, 3, 1000, 50_000):
        keys = np.random.default_rng(n).integers(0, 1 << 63, n, np.int64).view(np.uint64)
        made = PerfectHash(build(np.unique(keys)))
        again = PerfectHash.unpacked(*made.packed())
        for found in (made, again):
            assert sorted(found.slots(np.unique(keys)).tolist()) == list(range(len(np.unique(keys))))
    assert PerfectHash(build(np.zeros(0, np.uint64))).slots(np.arange(3, dtype=np.uint64)).tolist() == [-1, -1, -1]


@pytest.mark.parametrize("way", [{}, {"most_bytes": 0}, {"most_bytes": 0, "shard_keys": 2, "slot_rows": 5}, {"shard_keys": 2}])
def test_lines_equal_brute_force(spark, way):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sorted(map(tuple, lines.without_common_lines(docs, **way).collect()), key=repr)
    assert found == _plain(rows)


def test_partial_sums_are_given_out_when_a_task_holds_many(spark, monkeypatch):
    rows = _rows()
    plain = lines._count
    monkeypatch.setattr(lines, "_count", lambda least_chars: plain(least_chars, 8))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    found = sorted(map(tuple, lines.without_common_lines(docs).collect()), key=repr)
    assert found == _plain(rows)


def test_fingerprints_refuse_keys_outside_the_set():
    rng = np.random.default_rng(5)
    h, f = (rng.integers(-(1 << 62), 1 << 62, 2000) for _ in range(2))
    table = pa.table({"h": h[:1000], "f": f[:1000], "n": np.full(1000, 3), "doc": pa.array(range(1000)), "shard": pa.array([0] * 1000, pa.int32())})
    arrays = lines.Arrays(lines._shard(table).to_pylist()[0])
    doc, has = np.full(2000, 7), np.ones(2000, bool)
    found = arrays.others_hold(h, f, doc, has, 3)
    assert found[:1000].sum() == 999 and not found[7] and not found[1000:].any()


def test_empty_table(spark):
    assert lines.without_common_lines(spark.createDataFrame([], SCHEMA)).collect() == []
