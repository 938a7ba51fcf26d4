import random

import pytest

import corpus_pipeline
from stridecast.llm import pii
from stridecast.scratch import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(3)
    syllables = {"en": ["th", "ing", "ou"], "de": ["sch", "ung", "ei"], "fr": ["eau", "oi", "é"]}

    def prose(lang, n):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(2, 6))) + str(rng.randrange(40)) for _ in range(n))

    rows = []
    for i in range(150):
        lang = rng.choice(list(syllables))
        rows.append([i, prose(lang, 120), lang])
    item = prose("en", 30)
    rows += [[200, "123 456 --", "en"], [201, None, None], [202, "", "en"]]
    rows += [[300 + i, rows[i][1], rows[i][2]] for i in range(6)]
    rows.append([400, prose("en", 50) + " " + item + " " + prose("en", 50), "en"])
    rows.append([401, prose("en", 150) + " mail me: a.b@example.com", "en"])
    folder = str(tmp_path_factory.mktemp("tables"))
    full = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
    spark.createDataFrame(full, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item), (1, prose("de", 25))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_decides(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    seen = [{r["doc_id"] for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, tables), name)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        seen.append({r["doc_id"] for r in docs.collect()})
    assert seen[0] - seen[1] == {200, 201, 202}
    assert seen[1] - seen[2] == {300 + i for i in range(6)}
    assert seen[2] - seen[3] == {400}
    assert seen[3] == seen[4]
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
    assert texts[401][0].endswith(" mail me: [EMAIL]") and texts[401][1] == len(texts[401][0])
    assert pii.with_pii(docs).where("size(pii) > 0").count() == 0


def test_run_packs_what_is_left(spark, tables):
    pieces = corpus_pipeline.run(spark, tables).collect()
    assert {p["doc_id"] for p in pieces} == set(range(150)) | {401}
    for doc in {p["doc_id"] for p in pieces}:
        own = sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == doc)
        assert [a for a, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]


def test_empty_tables_pass_every_stage(spark, tables, folder):
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_rows_without_an_id_are_decided_one_by_one(spark, folder):
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefghijk", k=6)) for _ in range(n))

    item, copied = prose(30), prose(200)
    texts = {"clean": prose(120), "other": prose(120), "leak": prose(60) + " " + item + " " + prose(60), "twin": prose(200), "copied": copied}
    rows = [(None, t) for t in texts.values()] + [(None, texts["twin"].upper()), (None, copied.upper()), (1, copied), (2, prose(90)), (2, prose(90) + " " + item)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect()]
    twins = {(None, texts["twin"]), (None, texts["twin"].upper())}
    assert len(twins & set(left)) == 1
    assert set(left) - twins == {(None, texts[k]) for k in ("clean", "other", "leak")} | {(1, copied), *rows[-2:]}
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.decontaminated(spark, docs, folder).collect()]
    assert sorted(left, key=str) == sorted((r for r in rows if item not in r[1]), key=str)


def test_rows_that_repeat_are_kept_once(spark, folder):
    rng = random.Random(9)
    a, b, c = (" ".join("".join(rng.choices("abcdefghijk", k=6)) for _ in range(150)) for _ in range(3))
    rows = [(9, a, "x"), (9, a, "w"), (9, a, "w"), (9, a, None)] + [(None, b, "s")] * 5 + [(3, c, "s"), (3, c.upper(), "s"), (4, c, "s"), (4, None, "s"), (4, None, "s")]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], DOCS).repartition(4)
    left = [(r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect()]
    chosen = c if (3, c, "s") in left else c.upper()
    assert sorted(left, key=str) == sorted([(9, a, None), (None, b, "s"), (3, chosen, "s"), (4, None, "s")], key=str)
    hot = docs.where("doc_id IS NULL").crossJoin(spark.range(400)).drop("id")
    assert corpus_pipeline.near_duplicates(spark, hot, folder).count() == 1
