"""Work that must not grow faster than the tables: message files, promotion, and the queries around them."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from stridecast.plans import promotion
from stridecast.plans.promotion import latest_rows, latest_rows_gathered, repeats_by_month
from stridecast.schema import SCORED_SCHEMA
from stridecast.scratch import written
from stridecast.sources import store as stores
from stridecast.sources.files import list_parquet_files
from stridecast.sources.kafka import MessageConfig, publish
from stridecast.sources.store import FileStore
from tests.conftest import SMALL
from workload import streams, tables


def rows_of(spark, *rows):
    """(date, id, epoch)"""
    at = dt.datetime(2024, 1, 1, 10)
    full = [(dt.date.fromisoformat(d) if d else None, "c", float(e), "{}", "m", e, at, True, 0.0, at, None, None, i, "batch") for d, i, e in rows]
    return spark.createDataFrame(full, SCORED_SCHEMA)


def seen(df):
    return sorted((str(r["date"]), str(r["message_id"]), r["epoch_id"]) for r in df.collect())


def files_below(spark, folder):
    return list_parquet_files(spark, folder).count()


def test_message_files_are_compressed_and_not_long(spark, folder, monkeypatch):
    monkeypatch.setitem(streams.publish.__globals__["FILES"], "maxRecordsPerFile", "10")
    publish(spark.range(0, 25, 1, 1).selectExpr("string(id) AS value"), MessageConfig(folder=folder))
    back = spark.read.text(folder)
    assert len(back.inputFiles()) == 3 and all(f.endswith(".snappy") for f in back.inputFiles())
    assert sorted(int(r["value"]) for r in back.collect()) == list(range(25))


def test_rows_without_repeats_are_added_and_old_versions_stay(spark, folder):
    store = FileStore(spark, folder)
    store.write_batch(rows_of(spark, ("2021-01-01", "a", 0), ("2021-02-01", "b", 0)), 0)
    assert store.promote() == 2
    store.write_batch(rows_of(spark, ("2021-01-05", "c", 1), ("2021-02-01", "b", 1)), 1)
    assert store.promote() == 2
    versions = store._versions(store.manifest.rows())
    # January's first version stays and has a second one beside it; February is written anew.
    assert [versions[m].count(",") for m in ("2021-01", "2021-02")] == [1, 0]
    assert seen(store.predictions()) == [("2021-01-01", "a", 0), ("2021-01-05", "c", 1), ("2021-02-01", "b", 1)]
    assert seen(store.predictions(["2021-01"])) == [("2021-01-01", "a", 0), ("2021-01-05", "c", 1)]
    second = versions["2021-01"].split(",")[1]
    assert spark.read.parquet(f"{store.data}/version={second}/period=2021-01").count() == 1


def test_a_month_in_many_versions_is_written_anew(spark, folder, monkeypatch):
    monkeypatch.setattr(stores, "MANY_VERSIONS", 2)
    store = FileStore(spark, folder)
    lengths = []
    for e in range(4):
        store.write_batch(rows_of(spark, ("2021-01-01", f"k{e}", e)), e)
        store.promote()
        lengths.append(store._versions(store.manifest.rows())["2021-01"].count(",") + 1)
    assert lengths == [1, 2, 1, 2]
    assert seen(store.predictions()) == [("2021-01-01", f"k{e}", e) for e in range(4)]


def test_promotions_of_one_driver_do_not_merge_the_same_batches(spark, folder, monkeypatch):
    merged, plain = [], FileStore._merge
    monkeypatch.setattr(FileStore, "_merge", lambda self, *given: merged.append(len(given[0])) or plain(self, *given))
    for e in range(4):
        FileStore(spark, folder).write_batch(rows_of(spark, ("2021-01-01", f"k{e}", e)), e)
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda _: FileStore(spark, folder).promote(), range(4)))
    assert merged == [4] and sorted(counts) == [0, 0, 0, 1]
    assert len(seen(FileStore(spark, folder).predictions())) == 4


def test_many_repeats_are_compared_in_ranges(spark, folder, monkeypatch):
    monkeypatch.setattr(promotion, "HOT", 50)
    days = "date_add(date'2021-01-01', int(id % 90))"
    key = "CASE WHEN id % 7 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL WHEN id % 3 = 0 THEN sha2(string(id % 900), 256) ELSE string(id % 900) END"
    # Keys of id % 900 lie in one month each, as 90 divides 900; 'hot' and NULL lie in all.
    rows = spark.range(0, 4_000, 1, 4).selectExpr(
        f"IF(id % 11 = 0, NULL, {days}) AS date", f"{key} AS message_id", "'m' AS model", "int(id % 13) AS epoch_id", "id AS created_at", "string(id) AS v"
    )
    held = written(rows.withColumn("period", F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none"))), "held")
    month = F.coalesce(F.year("date") * 12 + F.month("date"), F.lit(-1))
    repeated = written(repeats_by_month(held, month), "repeated")
    n, n_apart = repeated.count(), repeated.where(f"n > 50 OR lo <> hi").count()
    assert 0 < n_apart < n
    frames = latest_rows_gathered(held, repeated, n, n_apart, "period", few=n_apart)
    assert len(frames) == 2 and all(f.columns == held.columns for f in frames)
    assert sorted(map(str, frames[0].unionByName(frames[1]).collect())) == sorted(map(str, latest_rows(held).collect()))
    # The rows are shuffled once, in ranges, on their way to the months.
    assert frames[1]._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning" not in frames[1]._jdf.queryExecution().executedPlan().toString()
    for few in (n, n_apart - 1):
        [frame] = latest_rows_gathered(held, repeated, n, n_apart, "period", few=few)
        assert sorted(map(str, frame.collect())) == sorted(map(str, latest_rows(held).collect()))


def test_each_line_number_has_the_same_number_of_files(spark, folder):
    rows = spark.range(0, 1_000, 1, 4).selectExpr("id", "CASE WHEN id < 3 THEN 1 WHEN id < 300 THEN 2 ELSE 3 END AS l_linenumber")
    assert streams._write_in_turn(spark, rows, folder, at_most=100) == (3, 7)
    found = spark.read.parquet(folder).groupBy("l_linenumber", F.col("_metadata.file_path").alias("f")).count().collect()
    assert max(r["count"] for r in found) <= 200 and sum(r["count"] for r in found) == 1_000
    order = [r["path"] for r in list_parquet_files(spark, folder).orderBy("modificationTime").collect()]
    assert len(order) == 21 and [{r["l_linenumber"] for r in found if r["f"] in order[i : i + 7]} for i in (0, 7, 14)] == [{1}, {2}, {3}]


def test_replay_of_a_table_takes_a_bounded_number_of_batches(spark, settings, monkeypatch):
    limits, plain = [], streams.stream_table
    monkeypatch.setattr(streams, "stream_table", lambda *a, **k: limits.append(k["max_files_per_trigger"]) or plain(*a, **k))
    settings(spark__sql__files__maxRecordsPerFile="500")
    outcome = {r["outcome"]: r["n"] for r in streams.t13_rejects(spark, SMALL).collect()}
    assert limits[0] > 1 and outcome["sent"] + outcome["observed as rejected"] == outcome["observed as read"]


def test_two_models_score_messages_made_once(spark, monkeypatch):
    made, plain = [], streams._messages
    monkeypatch.setattr(streams, "_messages", lambda *a: made.append(1) or plain(*a))
    assert streams.t9_models(spark, SMALL).count() == 2 and len(made) == 1


def test_messages_of_two_models_are_gzipped(spark, monkeypatch):
    folders, plain = [], streams.publish
    monkeypatch.setattr(streams, "publish", lambda rows, cfg: folders.append(cfg.folder) or plain(rows, cfg))
    streams.t9_models(spark, SMALL)
    files = spark.read.text(folders[0]).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
    assert spark.read.text(folders[0]).count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_ranges_of_dates_hold_whole_months():
    counts = [{"lo": lo, "hi": lo + 9, "n": n} for lo, n in ((60, 5), (0, 5), (30, 5), (-30, 20), (90, 1))] + [{"lo": None, "hi": None, "n": 3}]
    assert promotion.date_ranges(counts, 10) == [(-30, -21, 20), (0, 39, 10), (60, 99, 6), (None, None, 3)]
    assert promotion.date_ranges(counts, 1, most=2) == [(-30, -21, 20), (0, 99, 16), (None, None, 3)]
    assert promotion.date_ranges([], 10) == []


def _of_model(spark, model, ids, epoch=0):
    """Valid rows over eight months and without a date, in no order; every eleventh id is refused."""
    return spark.range(0, ids, 1, 3).selectExpr(
        "IF(id % 13 = 0, NULL, date_add(date'2020-11-03', int(id * 37 % 240))) AS date", "'c' AS country", "double(id) AS residential", "'{}' AS features_json",
        f"'{model}' AS model", f"{epoch} AS epoch_id", "timestamp'2024-01-01 10:00:00' AS created_at", "id % 11 <> 0 AS is_valid", "double(id) AS prediction",
        "timestamp'2024-01-01 10:00:00' AS event_time", "string(null) AS reject_reason", "string(null) AS raw_value",
        "IF(id % 17 = 0, NULL, sha2(string(id), 256)) AS message_id", f"'{model}' AS stream_id",
    )


def test_staged_files_are_in_the_order_of_dates(spark, folder):
    store = FileStore(spark, folder)
    store.write_batch(_of_model(spark, "a", 300), 0, "a")
    files = [r["path"] for r in list_parquet_files(spark, store.staging).collect() if "is_valid=true" in r["path"]]
    assert len(files) == 3
    for file in files:
        days = [r["date"] for r in spark.read.parquet(file).collect()]
        assert len(set(days)) > 2 and days == sorted(days, key=lambda d: (d is not None, d))


def test_months_without_repeats_are_written_from_ranges_without_a_shuffle(spark, folder, monkeypatch):
    for name, value in (("TASK_ROWS", 50), ("LEAST_ROWS", 1)):
        monkeypatch.setattr(promotion, name, value)
    frames, plain = [], stores.gathered_of_files
    monkeypatch.setattr(stores, "gathered_of_files", lambda *given: frames.append(plain(*given)) or frames[-1])
    store, both = FileStore(spark, folder), [_of_model(spark, m, 600).where("message_id IS NOT NULL") for m in "ab"]
    for model, rows in zip("ab", both):
        store.write_batch(rows, 0, model)
    # Months from November to June, and the rows without a date.
    assert store.promote() == 9
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan parquet") > 5
    # Each range has tasks of its own: the union is not one partition.
    assert frames[0].select(F.spark_partition_id()).distinct().count() >= plan.count("Scan parquet")
    wanted = both[0].unionByName(both[1]).where("is_valid").select(*stores.PREDICTION_COLUMNS)
    assert sorted(map(str, store.predictions().collect())) == sorted(map(str, wanted.collect()))
    # A later batch repeats keys of one month and of the rows without a date, and adds to the others.
    more = _of_model(spark, "a", 600, 1).withColumn("message_id", F.expr("CASE WHEN date IS NULL OR month(date) = 1 THEN message_id ELSE sha2(string(-residential - 1), 256) END"))
    store.write_batch(more.where("message_id IS NOT NULL"), 1, "a")
    assert store.promote() == 9 and len(frames) == 2
    wanted = latest_rows(wanted.unionByName(more.where("is_valid AND message_id IS NOT NULL").select(*wanted.columns)))
    assert sorted(map(str, store.predictions().collect())) == sorted(map(str, wanted.collect()))
    versions = store._versions(store.manifest.rows())
    assert {m: v.count(",") for m, v in versions.items()} == {m: int(m not in ("none", "2021-01")) for m in versions}


def test_few_rows_in_many_files_are_shuffled(spark, folder, monkeypatch):
    frames, plain = [], stores.gathered_of_files
    monkeypatch.setattr(stores, "gathered_of_files", lambda *given: frames.append(plain(*given)) or frames[-1])
    store = FileStore(spark, folder)
    store.write_batch(_of_model(spark, "a", 300).where("message_id IS NOT NULL"), 0, "a")
    store.promote()
    assert "Exchange" in frames[0]._jdf.queryExecution().executedPlan().toString()


def test_months_fit_one_file_whatever_the_advisory_size(spark, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="1k")
    months = tables.k1_compact(spark, SMALL).collect()
    assert months and all(r["one_file"] for r in months)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "1k"
    assert [tables._bytes(t) for t in ("67108864b", "64MB", "2k", "10")] == [64 << 20, 64 << 20, 2048, 10]
