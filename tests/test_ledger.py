"""Numbered entries, snapshots, and promotions that run at once."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import types as T

from stridecast.schema import SCORED_SCHEMA
from stridecast.sources.ledger import Ledger, create_file, newest
from stridecast.sources.store import FileStore

SHAPE = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.IntegerType())])


def test_a_file_is_created_once_and_whole(spark, folder):
    path = f"{folder}/deep/one.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: create_file(spark, path, f"text {i}"), range(8)))
    assert made.count(True) == 1
    assert [r["value"] for r in spark.read.text(f"{folder}/deep").collect()] == [f"text {made.index(True)}"]


def test_entries_of_many_writers_have_no_gaps(spark, folder):
    with ThreadPoolExecutor(6) as pool:
        turns = list(pool.map(lambda i: Ledger(spark, folder, SHAPE, every=5).append([{"name": "a", "value": i}]), range(24)))
    assert sorted(turns) == list(range(1, 25))
    rows, last = Ledger(spark, folder, SHAPE, every=5).state()
    assert last == 24 and sorted(r["value"] for r in rows.collect()) == list(range(24))


def test_swap_refuses_an_old_state(spark, folder):
    ledger = Ledger(spark, folder, SHAPE)
    _, before = ledger.state()
    assert before == 0 and ledger.append([{"name": "a", "value": 1}], after=before) == 1
    assert ledger.append([{"name": "a", "value": 2}], after=before) is None
    assert ledger.append([{"name": "a", "value": 3}], after=1) == 2
    assert sorted(r["value"] for r in ledger.rows().collect()) == [1, 3]


def test_readers_open_a_bounded_number_of_files(spark, folder):
    ledger = Ledger(spark, folder, SHAPE, lambda rows: newest(rows, ("name",), "value"), every=10)
    opened = []
    for i in range(87):
        ledger.append([{"name": f"n{i % 7}", "value": i}])
        if i % 9 == 0:
            opened.append(len(ledger.rows().inputFiles()))
    assert max(opened) <= 12
    seen = {r["name"]: r["value"] for r in newest(ledger.rows(), ("name",), "value").collect()}
    assert seen == {f"n{i % 7}": i for i in range(80, 87)}
    # A snapshot that was not written is made up for by the next one.
    spark_rows, last = ledger.state()
    assert last == 87 and spark_rows.count() == 7 + 7


def test_missing_snapshot_costs_nothing_but_reading(spark, folder):
    ledger = Ledger(spark, folder, SHAPE, every=4)
    ledger.snapshot = lambda: None
    for i in range(10):
        ledger.append([{"name": "a", "value": i}])
    again = Ledger(spark, folder, SHAPE, every=4)
    assert again.state()[1] == 10 and again.rows().count() == 10
    again.append([{"name": "a", "value": 10}])
    again.append([{"name": "a", "value": 11}])
    assert again._snapshot() == 12 and again.rows().count() == 12 and again._turns(12) == []


def _rows(spark, *rows):
    at = dt.datetime(2024, 1, 1, 10)
    full = [(dt.date.fromisoformat(d), c, float(e), "{}", "m", e, at, True, 0.0, at, None, None, f"{d}|{c}", "s") for d, c, e in rows]
    return spark.createDataFrame(full, SCORED_SCHEMA)


def _seen(store):
    return sorted((str(r["date"]), r["country"], r["epoch_id"]) for r in store.predictions().collect())


def test_a_promotion_that_was_overtaken_begins_again(spark, folder, monkeypatch):
    slow, quick = FileStore(spark, folder), FileStore(spark, folder)
    slow.write_batch(_rows(spark, ("2021-01-01", "a", 0)), 0, "s")
    plain = FileStore._merge

    def overtaken(self, *given):
        made = plain(self, *given)
        if self is slow and not quick.manifest.state()[1]:
            quick.write_batch(_rows(spark, ("2021-01-02", "b", 1)), 1, "s")
            assert quick.promote() == 1
        return made

    monkeypatch.setattr(FileStore, "_merge", overtaken)
    # Its batch was taken in meanwhile, together with the later one.
    assert slow.promote() == 0
    assert _seen(slow) == [("2021-01-01", "a", 0), ("2021-01-02", "b", 1)]


def test_promotions_at_once_lose_no_row(spark, folder):
    def one(i):
        store = FileStore(spark, folder, every=4)
        store.write_batch(_rows(spark, ("2021-01-01", f"c{i}", i), (f"2021-0{i % 3 + 2}-01", f"c{i}", i)), i, f"s{i}")
        store.promote()

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, range(6)))
    store = FileStore(spark, folder, every=4)
    assert store.promote() == 0
    assert _seen(store) == sorted([("2021-01-01", f"c{i}", i) for i in range(6)] + [(f"2021-0{i % 3 + 2}-01", f"c{i}", i) for i in range(6)])
