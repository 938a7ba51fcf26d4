"""Streams against tables, restarts, late rows, staging and promotion."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stridecast.functions.messages import flatten_message, parse_messages
from stridecast.operators.regression import train
from stridecast.plans.promotion import latest_rows, latest_rows_of_files, promote_rows, repeated_keys
from stridecast.plans.scoring import score_batch
from stridecast.schema import METRICS, SCORED_SCHEMA, FeatureContract
from stridecast.sources.files import stream_table
from stridecast.sources.kafka import MessageConfig, mobility_stream, publish
from stridecast.sources.store import FileStore
from stridecast.streaming import windows
from stridecast.streaming.latency import latency, progress_rows
from stridecast.streaming.replay import message_stream, start_replay
from stridecast.streaming.runs import finish, start_batches
from stridecast.streaming.scoring import start_scoring
from tests.test_files import mobility

SCHEMA = "event_time timestamp, country string, value double"
CONTRACT = FeatureContract("retail", ("grocery", "workplaces"))


def at(text):
    return dt.datetime.fromisoformat(f"2024-01-01 {text}:00")


def message(i, day="2021-03-04", country="Morocco"):
    metrics = {m: float(i + k) for k, m in enumerate(METRICS)}
    return json.dumps(
        {
            "type": "mobility",
            "timestamp": "2024-01-01T00:00:00",
            "data": {"date": day, "country": country, "metrics": metrics},
        }
    )


def send(spark, cfg, *values):
    publish(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), cfg)


def test_late_rows_are_dropped_across_runs(spark, folder):
    source, sink, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"

    def run(*rows):
        if rows:
            spark.createDataFrame([(at(t), "a", v) for t, v in rows], SCHEMA).coalesce(1).write.mode(
                "append"
            ).parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        found = windows.window_metrics(stream, watermark="15 minutes", metrics=("value",))
        query = finish(windows.start_closed_windows(found, sink, checkpoint))
        late = progress_rows(spark, query).agg(F.sum("n_late")).first()[0]
        seen = spark.read.parquet(sink).orderBy("window_start").collect()
        return [(r["window_start"], r["n"], r["avg_value"]) for r in seen], late

    assert run(("10:01", 1.0), ("10:05", 1.0), ("11:00", 5.0))[0] == [(at("10:00"), 2, 1.0)]
    rows, late = run(("10:07", 100.0), ("12:00", 7.0))
    assert rows == [(at("10:00"), 2, 1.0), (at("11:00"), 1, 5.0)] and late == 1
    assert run()[0] == rows


def test_messages_without_a_time_are_set_aside_once(spark, folder):
    cfg = MessageConfig(folder=f"{folder}/messages")
    soon = message(2).replace("2024-01-01T00:00:00", "soon")
    send(spark, cfg, message(1), soon, "garbage")
    flat = flatten_message(parse_messages(mobility_stream(spark, cfg)))
    for _ in range(2):
        finish(windows.start_untimed(flat, f"{folder}/rejects", f"{folder}/checkpoint"))
    seen = spark.read.parquet(f"{folder}/rejects").collect()
    assert sorted(map(tuple, seen)) == [("garbage", "malformed"), (soon, "no readable time")]


def test_changing_windows_keep_the_latest_state(spark, folder):
    source, sink, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"
    for value in (1.0, 3.0):
        spark.createDataFrame([(at("10:01"), "a", value)], SCHEMA).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        found = windows.window_metrics(stream, metrics=("value",))
        finish(windows.start_changing_windows(found, sink, checkpoint))
    assert spark.read.parquet(sink).count() == 2
    row = windows.current_windows(spark, sink).first()
    assert (row["n"], row["avg_value"], row["window_end"]) == (2, 2.0, at("10:15"))


def test_scoring_stream_equals_batch_and_survives_restart(spark, folder):
    cfg = MessageConfig(folder=f"{folder}/messages")
    store, checkpoint = FileStore(spark, f"{folder}/store"), f"{folder}/checkpoint"
    table = spark.range(40).selectExpr("id * 2.0 + 1 AS retail", "double(id) AS grocery", "double(id % 7) AS workplaces")
    model = train(table, CONTRACT)
    first = [message(i) for i in range(20)] + ["garbage", message(1).replace("2.0", "null", 1)]
    second = [message(i, day="2021-04-05") for i in range(5)]
    send(spark, cfg, *first)
    finish(start_scoring(mobility_stream(spark, cfg), store, checkpoint, model))
    send(spark, cfg, *second)
    for _ in range(2):
        finish(start_scoring(mobility_stream(spark, cfg), store, checkpoint, model))
    staged = store.staged()
    assert staged.schema == SCORED_SCHEMA
    assert {r["epoch_id"]: r["count"] for r in staged.groupBy("epoch_id").count().collect()} == {0: 22, 1: 5}

    def comparable(df):
        return sorted(map(str, df.drop("created_at", "stream_id").collect()))

    batches = [
        score_batch(spark.createDataFrame([(v,) for v in part], "value string"), i, model)
        for i, part in enumerate((first, second))
    ]
    assert comparable(staged) == comparable(batches[0].unionByName(batches[1]))
    assert store.quarantined().count() == 2


def test_repeated_batch_leaves_no_duplicates(spark, folder):
    store = FileStore(spark, folder)
    scored = score_batch(spark.createDataFrame([(message(1),), ("bad",)], "value string"), 3)
    store.write_batch(scored, 3)
    store.write_batch(scored, 3)
    assert store.staged().count() == 2


def predictions(spark, *rows):
    """(date, country, epoch, residential, valid)"""
    full = [
        (dt.date.fromisoformat(d) if d else None, c, float(r), "{}", "m", e, at("10:00"), v, 0.0, at("09:00"), None, None, f"{d}|{c}", "batch")
        for d, c, e, r, v in rows
    ]
    return spark.createDataFrame(full, SCORED_SCHEMA)


def values(df):
    return sorted((str(r["date"]), r["country"], r["epoch_id"], r["residential"]) for r in df.collect())


def test_promote_rows_is_idempotent(spark):
    staged = predictions(
        spark,
        ("2021-01-01", "a", 0, 1, True),
        ("2021-01-01", "a", 2, 2, True),
        ("2021-01-01", "a", 3, 9, False),
        ("2021-01-02", "a", 1, 4, True),
        (None, "b", 1, 5, True),
    )
    once = promote_rows(staged)
    assert values(once) == [("2021-01-01", "a", 2, 2.0), ("2021-01-02", "a", 1, 4.0), ("None", "b", 1, 5.0)]
    assert values(promote_rows(staged, once)) == values(once)


def test_latest_row_of_a_hot_key(spark):
    rows = spark.range(0, 20_000, 1, 8).selectExpr(
        "date'2021-01-01' AS date", "'a' AS country", "'m' AS model", "int(id % 1000) AS epoch_id", "id AS created_at", "id AS v"
    )
    assert latest_rows(rows, keys=("date", "country", "model")).first()["v"] == 19_999


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_rows_alone_under_their_key_pass_beside_compared_ones(spark, folder, few):
    rows = spark.range(0, 2_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS k", "'m' AS model", "int(id % 100) AS epoch_id", "id AS created_at", "string(id) AS v"
    )
    rows.unionByName(rows.where("created_at % 10 = 0")).write.parquet(folder)
    held = spark.read.parquet(folder)
    expected: dict = {}
    for r in held.collect():
        best = expected.setdefault(r["k"], r)
        if (r["epoch_id"], r["created_at"], r["v"]) > (best["epoch_id"], best["created_at"], best["v"]):
            expected[r["k"]] = r
    found = latest_rows_of_files(held, ("k", "model"), few=few)
    assert found.columns == held.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.values()))
    for none in (held.where("false"), found.where("k > 7")):
        assert sorted(map(str, latest_rows_of_files(none, ("k", "model"), few=few).collect())) == sorted(map(str, none.collect()))


def test_keys_that_repeat_are_found_without_sorting(spark, folder):
    predictions(spark, ("2021-01-01", "a", 0, 1, True), ("2021-01-01", "a", 1, 2, True), ("2021-01-02", "a", 0, 3, True)).write.parquet(folder)
    held = spark.read.parquet(folder)
    plan = repeated_keys(held)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "features_json" not in plan and plan.count("HashAggregate") == 2
    assert repeated_keys(held).count() == 1
    merged = latest_rows_of_files(held)._jdf.queryExecution().executedPlan().toString()
    passed, compared = merged.split("LeftAnti")[0], merged.split("LeftAnti")[1]
    assert "Sort" not in passed.split("Union")[1] and "SortAggregate" in compared


def test_store_promotes_only_new_epochs_and_touched_months(spark, folder):
    store = FileStore(spark, folder)
    assert store.promote() == 0 and store.predictions().count() == 0
    store.write_batch(
        predictions(spark, ("2021-01-01", "a", 0, 1, True), ("2021-02-01", "a", 0, 2, True), (None, "n", 0, 3, True)), 0
    )
    assert store.promote() == 3
    store.write_batch(predictions(spark, ("2021-02-01", "a", 1, 8, True), ("2021-02-02", "b", 1, 9, False)), 1)
    assert store.promote() == 1
    expected = [("2021-01-01", "a", 0, 1.0), ("2021-02-01", "a", 1, 8.0), ("None", "n", 0, 3.0)]
    assert values(store.predictions()) == expected
    assert store.promote() == 0 and values(store.predictions()) == expected
    assert values(store.predictions(months=["2021-02"])) == [("2021-02-01", "a", 1, 8.0)]


def test_streams_do_not_share_batch_numbers(spark, folder):
    store = FileStore(spark, folder)
    for stream, country in (("one", "a"), ("two", "b")):
        store.write_batch(predictions(spark, ("2021-01-01", country, 0, 1, True)), 0, stream)
        assert store.promote() == 1
    assert {(r["country"], r["stream_id"]) for r in store.predictions().collect()} == {("a", "one"), ("b", "two")}
    store.write_batch(predictions(spark, ("2021-01-01", "c", 1, 1, False)), 1, "one")
    assert store.promote() == 0 and store.promote() == 0
    with pytest.raises(ValueError, match="stream id"):
        store.write_batch(predictions(spark), 0, "a/b")


def test_a_repeated_batch_is_taken_in_again(spark, folder):
    store = FileStore(spark, folder)
    store.write_batch(predictions(spark, ("2021-01-01", "a", 0, 1, True)), 0)
    assert store.promote() == 1
    store.write_batch(predictions(spark, ("2021-01-01", "a", 0, 1, True), ("2021-01-01", "b", 0, 2, True)), 0)
    assert store.promote() == 1 and store.staged().count() == 2
    assert values(store.predictions()) == [("2021-01-01", "a", 0, 1.0), ("2021-01-01", "b", 0, 2.0)]


def test_unfinished_promotion_is_invisible(spark, folder):
    store = FileStore(spark, folder)
    store.write_batch(predictions(spark, ("2021-01-01", "a", 0, 1, True)), 0)
    store.promote()
    half_done = predictions(spark, ("2021-01-01", "a", 1, 7, True))
    half_done.withColumn("period", F.lit("2021-01")).write.partitionBy("period").parquet(f"{store.data}/version=1")
    assert values(store.predictions()) == [("2021-01-01", "a", 0, 1.0)]
    store.write_batch(predictions(spark, ("2021-01-01", "a", 1, 8, True)), 1)
    store.promote()
    assert values(store.predictions()) == [("2021-01-01", "a", 1, 8.0)]


def test_replay_is_paced_by_files(spark, folder):
    mobility(spark, 12).repartition(3).write.parquet(f"{folder}/table")
    cfg = MessageConfig(folder=f"{folder}/messages")
    messages = message_stream(spark, f"{folder}/table", max_files_per_trigger=1)
    query = finish(start_replay(messages, cfg, f"{folder}/checkpoint"))
    assert [r["n_input"] > 0 for r in progress_rows(spark, query).collect()].count(True) == 3
    sent = [json.loads(r["value"]) for r in spark.read.text(cfg.folder).collect()]
    assert len(sent) == 24 and {m["data"]["country"] for m in sent} == {"Morocco", "Spain"}


def test_stream_of_a_single_file_and_of_a_folder(spark, folder):
    counts = []
    for path in ("/root/testdata/sf0.001/nation.parquet", f"{folder}/nation.parquet"):
        if path.startswith(folder):
            spark.read.parquet("/root/testdata/sf0.001/nation.parquet").repartition(2).write.parquet(path)
        seen = []
        finish(start_batches(stream_table(spark, path), lambda b, i: seen.append(b.count()), f"{folder}/c{len(counts)}"))
        counts.append(sum(seen))
    assert counts == [25, 25]


def test_failed_batch_stops_the_query_and_is_repeated(spark, folder):
    cfg, seen = MessageConfig(folder=f"{folder}/messages"), []
    send(spark, cfg, "x")

    def broken(batch, batch_id):
        seen.append(batch_id)
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        finish(start_batches(mobility_stream(spark, cfg), broken, f"{folder}/checkpoint"))
    finish(start_batches(mobility_stream(spark, cfg), lambda b, i: seen.append((i, b.count())), f"{folder}/checkpoint"))
    assert seen == [0, (0, 1)]


def test_latency_percentiles(spark):
    rows = spark.range(1, 101).selectExpr(
        "1 AS epoch_id",
        "timestamp'2024-01-01 00:00:00' AS event_time",
        "timestamp'2024-01-01 00:00:00' + id * INTERVAL '1' SECOND AS created_at",
    )
    assert tuple(latency(rows).first()) == (1, 100, 50.0, 95.0, 100.0)
