"""Windows kept batch by batch, against one run over all rows."""

import datetime as dt
import random

from stridecast.sources.files import stream_table
from stridecast.streaming import windows
from stridecast.streaming.runs import finish

SCHEMA = "event_time timestamp, country string, value double"


def _rows(minutes, rng):
    return [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), rng.choice(["a", "b", None]), float(rng.randrange(9))) for m in minutes]


def _shown(df):
    return sorted(((r["window_start"], r["country"] or "", r["n"], r["avg_value"]) for r in df.collect()))


def test_table_equals_one_run_over_all_rows(spark, folder):
    rng = random.Random(2)
    parts = [_rows([60 * k + rng.randrange(-15, 60) for _ in range(40)], rng) for k in range(1, 7)]
    table = windows.WindowTable(spark, f"{folder}/table", every=3)
    everything = None
    for k, rows in enumerate(parts):
        part = spark.createDataFrame(rows, SCHEMA)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        everything = part if everything is None else everything.union(part)
        if k % 2:  # two batches a run, and a restart between runs
            stream = windows.window_metrics(stream_table(spark, f"{folder}/in", 1), watermark="90 minutes", metrics=("value",))
            table = windows.WindowTable(spark, f"{folder}/table", delay="90 minutes", every=3)
            finish(windows.start_window_table(stream, table, f"{folder}/checkpoint"))
    plain = windows.window_metrics(everything, metrics=("value",))
    assert _shown(table.current()) == _shown(plain)
    latest = max(r["window_start"] for r in plain.collect())
    still_open = table.open_windows()
    assert table.closed_windows().count() + still_open.count() == plain.count() > 2 * still_open.count()
    assert min(r["window_end"] for r in still_open.collect()) > latest - dt.timedelta(minutes=180)


def test_a_repeated_batch_changes_nothing(spark, folder):
    table = windows.WindowTable(spark, folder)
    assert table.open_windows() is None and table.closed_windows() is None
    shape = "window_start timestamp, window_end timestamp, country string, n long, avg_value double"
    assert table.current(spark.createDataFrame([], shape).schema).collect() == []

    def batch(*rows):
        start = dt.datetime(2024, 1, 1)
        step = dt.timedelta(minutes=15)
        return spark.createDataFrame([(start + i * step, start + (i + 1) * step, "a", n, 1.0) for i, n in rows], shape)

    table.update(batch((0, 1), (8, 1)), 0)
    table.update(batch((8, 5)), 1)
    once = _shown(table.current())
    table.update(batch((8, 9)), 1)
    table.update(batch((0, 9)), 0)
    assert _shown(table.current()) == once and [r[2] for r in once] == [1, 5]
    assert table.closed_windows().count() == 1
    # A batch whose folder was written without being logged is written again.
    spark.range(1).write.parquet(f"{folder}/attempt=lost/closed=false")
    table.update(batch((9, 2)), 3)
    assert [r[2] for r in _shown(table.current())] == [1, 5, 2]
