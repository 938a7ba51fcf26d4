"""Progress kept beyond a query, and rows that a replay leaves out."""

import json

import pytest
from pyspark.sql import functions as F

from stridecast.__main__ import main
from stridecast.sources.files import stream_table
from stridecast.sources.kafka import MessageConfig
from stridecast.streaming import windows
from stridecast.streaming.progress import ProgressLog, _batches
from stridecast.streaming.replay import checked_rows, message_stream, messages_of, refused_rows, start_refused, start_replay
from stridecast.streaming.runs import finish, start_batches
from tests.test_files import mobility

TEXT = "country_region string, date string, retail string, grocery string, residential int, transit string"


def _numbers(spark, folder, files):
    for i in range(files):
        spark.range(10 * i, 10 * i + 10, 1, 1).write.mode("append").parquet(folder)
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(folder)


def test_all_batches_of_a_long_run_and_a_restart_are_kept(spark, folder, settings):
    settings(spark__sql__streaming__numRecentProgressUpdates=3)
    stream = _numbers(spark, f"{folder}/in", 9)
    seen = stream.observe("seen", F.count(F.lit(1)).alias("rows"), F.max("id").alias("largest"), F.lit("text").alias("other"))
    with ProgressLog(spark, f"{folder}/log", every=4) as log:
        query = finish(start_batches(seen, lambda b, i: b.count(), f"{folder}/checkpoint"))
        log.wait(query)
    assert len(query.recentProgress) <= 3
    spark.range(90, 95, 1, 1).write.mode("append").parquet(f"{folder}/in")
    with ProgressLog(spark, f"{folder}/log", every=4) as log:
        log.wait(finish(start_batches(seen, lambda b, i: b.count(), f"{folder}/checkpoint")))
    rows = {r["batch_id"]: r for r in log.batches().where("n_input > 0").collect()}
    assert {k: r["n_input"] for k, r in rows.items()} == {**{i: 10 for i in range(9)}, 9: 5}
    assert {k: r["observed"] for k, r in rows.items()} == {
        i: {"seen.rows": r["n_input"], "seen.largest": 10 * i + r["n_input"] - 1} for i, r in rows.items()
    }
    assert log.totals().select("n_input", "n_late").collect() == [(95, 0)]
    assert len(log.ledger.rows().inputFiles()) < 10


def test_late_rows_are_counted(spark, folder):
    schema = "event_time timestamp, country string, value double"
    for text in ("2024-01-01 10:00:00", "2024-01-01 12:00:00", "2024-01-01 12:01:00", "2024-01-01 10:05:00"):
        spark.sql(f"SELECT timestamp'{text}' AS event_time, 'a' AS country, 1.0D AS value").write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    found = windows.window_metrics(stream, watermark="15 minutes", metrics=("value",))
    with ProgressLog(spark, f"{folder}/log") as log:
        log.wait(finish(windows.start_closed_windows(found, f"{folder}/out", f"{folder}/checkpoint")))
    assert log.totals().select("n_input", "n_late").collect() == [(4, 1)]


def test_an_idle_report_does_not_hide_a_batch(spark):
    shape = "turn long, query_id string, query_name string, batch_id long, n_input long, n_late long, trigger_ms long, observed map<string,long>"
    rows = [(1, "q", None, 0, 7, 1, 5, {"a.b": 2}), (2, "q", None, 0, 0, 0, 1, {}), (3, "p", "n", 0, 0, 0, 1, None)]
    found = _batches(spark.createDataFrame(rows, shape))
    assert sorted((r["query_id"], r["n_input"], r["n_late"], r["turn"]) for r in found.collect()) == [("p", 0, 0, 3), ("q", 7, 1, 1)]


def test_waiting_for_a_query_that_does_not_end(spark, folder):
    with ProgressLog(spark, f"{folder}/log") as log:
        query = start_batches(_numbers(spark, f"{folder}/in", 1), lambda b, i: b.count(), f"{folder}/checkpoint", interval="1 second")
        try:
            with pytest.raises(TimeoutError, match="no end of query"):
                log.wait(query, 0.2)
        finally:
            query.stop()


def _texts(spark):
    rows = [
        ("Morocco", "2021-03-04", "1", "2.5", 3, None),
        ("Spain", "soon", "1", "2", 4, "1"),
        (None, "2021-03-05", "n/a", "x", 5, "1"),
        ("Peru", None, "NaN", " 7 ", None, "1e3"),
        ("Chad", "2021-13-01", "", "2", 6, "1"),
    ]
    return spark.createDataFrame(rows, TEXT)


def test_refused_rows_keep_what_was_read(spark):
    checked = checked_rows(_texts(spark))
    found = {r["reject_reason"]: json.loads(r["raw_value"]) for r in refused_rows(checked).collect()}
    assert set(found) == {"date", "retail,grocery", "date,retail"}
    assert found["retail,grocery"] == {
        "country_region": None, "date": "2021-03-05", "retail": "n/a", "grocery": "x", "residential": 5, "transit": "1"
    }
    sent = [json.loads(r["value"])["data"] for r in messages_of(checked).collect()]
    assert [(m["country"], m["metrics"]["retail"], m["metrics"]["grocery"], m["metrics"]["transit"]) for m in sent] == [
        ("Morocco", 1.0, 2.5, None),
        ("Peru", None, 7.0, 1000.0),
    ]


def test_a_typed_table_has_nothing_to_refuse(spark):
    checked = checked_rows(mobility(spark, 5))
    assert refused_rows(checked).count() == 0 and messages_of(checked).count() == checked.count()


def test_replay_counts_and_sets_aside_once(spark, folder):
    _texts(spark).repartition(1).write.parquet(f"{folder}/table")
    cfg = MessageConfig(folder=f"{folder}/messages")
    for _ in range(2):
        checked = checked_rows(stream_table(spark, f"{folder}/table"))
        with ProgressLog(spark, f"{folder}/log") as log:
            log.wait(finish(start_replay(messages_of(checked), cfg, f"{folder}/checkpoint")))
            finish(start_refused(checked, f"{folder}/rejects", f"{folder}/checkpoint-rejects"))
    assert spark.read.text(cfg.folder).count() == 2 and spark.read.parquet(f"{folder}/rejects").count() == 3
    observed = [r["observed"] for r in log.batches().collect() if r["observed"]]
    assert observed == [{"replay.n_read": 5, "replay.n_rejected": 3}]
    assert message_stream(spark, f"{folder}/table").columns == ["value"]


def test_replay_command_with_rejects_and_progress(spark, folder, monkeypatch):
    monkeypatch.setattr("stridecast.__main__.build_session", lambda: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    _texts(spark).write.parquet(f"{folder}/table")
    main(
        ["replay", "--input", f"{folder}/table", "--folder", f"{folder}/messages", "--checkpoint", f"{folder}/c"]
        + ["--rejects", f"{folder}/rejects", "--progress", f"{folder}/log"]
    )
    assert spark.read.parquet(f"{folder}/rejects").count() == 3
    assert ProgressLog(spark, f"{folder}/log").batches().agg(F.sum(F.col("observed")["replay.n_rejected"])).first()[0] == 3
