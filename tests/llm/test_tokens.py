import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stridecast.llm import packing, token_files
from stridecast.llm.tokens import Encoder

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
ODD = [
    "", " ", "  \n", "a", " a  b\n\nc\t\td ", "it's we'll 12 3.4", "é é naïve", "a b　c\x85d\x1ce\x1f f",
    "x<|endoftext|> y", "a  <|endoftext|>  b", "<|startoftext|>", "日本語 текст", "🙂🙂 ok", "'s 't", "a\r\n b", "ﬀ ① ½",
]


def _texts():
    rng = random.Random(3)
    alphabet = "abcé's 12 \n\t\x1c\xa0 .,!日\U0001f642AB  "
    letters = "abcéÀßÿñZ"
    simple = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + rng.choice(["", ".", ",!", "$$$", "_", "'s"]) for _ in range(400)]
    return ODD + simple + [" ".join(simple[a : a + 9]) for a in range(0, 400, 9)] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(500)]


@pytest.mark.parametrize(("path", "spaces"), [(WORD, False), (BYTE, True)])
def test_pieces_give_the_ids_of_whole_texts(path, spaces):
    texts, plain = _texts(), Tokenizer.from_file(path)
    encoder = Encoder(path, spaces, limit=200)
    for a in range(0, len(texts), 50):
        for text, ids in zip(texts[a : a + 50], encoder.encode(pa.array(texts[a : a + 50])), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def _expected(rows, path):
    plain, out, before = Tokenizer.from_file(path), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        before += len(ids)
    return out


def test_token_files_round_trip(spark, folder):
    rows = [(i * 7 % 41, t, "x") for i, t in enumerate(_texts()[:41])] + [(50, None, None), (50, None, None), (None, "no id", "y")]
    token_files.write_token_files(_docs(spark, rows).repartition(3), folder, WORD)
    read = token_files.read_token_files(spark, folder)
    found = [tuple(r) for r in token_files.with_crc(read).collect()]
    assert sorted(found, key=lambda r: r[1]) == _expected([r[:2] for r in rows], WORD)
    assert read.where("doc_id = 50").count() == 2


def test_token_files_of_nothing(spark, folder):
    token_files.write_token_files(_docs(spark, []), folder, WORD)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_differencing_balances():
    sizes = np.random.default_rng(1).integers(1, 257, 900)
    bins = -(-int(sizes.sum()) // 2047)
    sums = np.bincount(packing.differencing(sizes, bins), sizes, bins)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() <= 2
    known = np.array([8, 7, 6, 5, 4])
    assert sorted(np.bincount(packing.differencing(known, 2), known)) == [14, 16]
    assert packing.differencing(np.array([5]), 3).tolist() == [0]


def test_packing_holds_every_id_once(spark):
    rng, plain = random.Random(5), Tokenizer.from_file(BYTE)
    texts = [" ".join(rng.choice(["the", "cat", "überaus", "42", "sat"]) for _ in range(rng.choice([0, 3, 90, 700, 5000]))) for _ in range(60)]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(99, None, None), (99, None, None), (None, "x", None)]
    pieces = packing.pack(_docs(spark, rows).repartition(2), BYTE, windows=8).collect()
    windows, docs = {}, {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        docs.setdefault(p["doc_id"], []).append((p["start"], np.frombuffer(p["ids"], "<u4").tolist(), p["doc_tokens"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for doc, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 1]
        assert sum((x for _, x, _ in sorted(docs[doc])), []) == ids and {n for *_, n in docs[doc]} == {len(ids)}
    assert sorted(docs[99]) == [(0, [1], 1)] * 2 and len(docs[None]) == 1
    # Little padding: at most one part-full group of windows for each task.
    assert len(windows) <= -(-sum(p["length"] for p in pieces) // 2047) + 2 * 2


def test_packing_nothing(spark):
    assert packing.with_crc(packing.pack(_docs(spark, []), BYTE)).count() == 0


def test_a_hot_id_lies_in_several_files(spark, folder, settings):
    """Two thirds of the rows have no id, half of them one text; every range holds a share of them."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(None, "copy of a text", "")] * 1500 + [(None, f"text {i}", "") for i in range(1500)] + [(i, f"own {i}", "") for i in range(1500)]
    token_files.write_token_files(_docs(spark, rows).repartition(6), folder, WORD)
    files = spark.read.orc(folder).groupBy("file_key").count().collect()
    assert len(files) == 8 and max(r["count"] for r in files) < 1.5 * len(rows) / 8
    found = token_files.with_crc(token_files.read_token_files(spark, folder)).collect()
    starts = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in found)
    assert [a for a, *_ in starts] == [sum(n for _, n, _ in starts[:i]) for i in range(len(starts))]
    ids = [-1 if d is None else d for *_, d in starts]
    assert ids == sorted(ids)
    plan = token_files.read_token_files(spark, folder)._jdf.queryExecution().toString()
    assert "ResolvedHint" not in plan and "strategy=broadcast" not in plan
