"""Messages in motion: replay, scoring, windows, staging and promotion.

Kafka and a database are not at hand here. Message files and Parquet tables
stand in for them; everything between source and sink is the same plan.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from stridecast.functions.messages import flatten_message, parse_messages, to_message
from stridecast.operators.filters import by_country
from stridecast.plans.promotion import promote_rows
from stridecast.plans.scoring import accepted, score_batch
from stridecast.schema import METRICS
from stridecast.scratch import new_folder
from stridecast.sources.files import list_parquet_files, stream_table
from stridecast.sources.kafka import MessageConfig, mobility_stream, publish
from stridecast.sources.store import FileStore
from stridecast.streaming import windows
from stridecast.streaming.latency import latency
from stridecast.streaming.progress import ProgressLog
from stridecast.streaming.replay import checked_rows, message_stream, messages_of, start_refused, start_replay
from stridecast.streaming.runs import finish, start_batches
from stridecast.streaming.scoring import start_scoring, stream_name
from workload.models import FIT_TRIO, TRIO, TRIO_VALUE, rounded, trained
from workload.registry import query
from workload.views import MOBILITY, as_mobility, metric_doubles, predictions, sql, table


#: Columns that together identify a row of ``lineitem``; the first four alone do not at every size.
KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _lineitem_messages(rows):
    """Message texts; the ship time stands for the sending time."""
    return to_message(as_mobility(rows, "l_shipdate", *KEY), F.col("l_shipdate"), KEY)


def _messages(spark, sf_dir):
    return _lineitem_messages(table(spark, sf_dir, "lineitem"))


def _message_stream(spark, sf_dir):
    table(spark, sf_dir, "lineitem")
    return message_stream(
        spark,
        f"{sf_dir}/lineitem.parquet",
        event_time=F.col("l_shipdate"),
        shape=lambda rows: as_mobility(rows, "l_shipdate", *KEY),
        key=KEY,
    )


def _scored_store(spark, sf_dir) -> FileStore:
    """The whole table as a message stream, scored into a fresh store."""
    store = FileStore(spark, new_folder(spark, "store"))
    checkpoint = new_folder(spark, "checkpoint")
    model = trained(spark, sf_dir)
    finish(start_scoring(_message_stream(spark, sf_dir), store, checkpoint, model))
    return store


_VECTOR = (
    "CAST(to_json(struct_pack(type := 'vector', size := 3, \"values\" := ["
    + ", ".join(f"CAST({f} AS DOUBLE)" for f in TRIO.features)
    + "])) AS VARCHAR)"
)
_SCORED_SQL = (
    "SELECT date, country_region AS country, CAST(residential AS DOUBLE) AS residential, "
    f"{_VECTOR} AS features_json, 'LinearRegression' AS model, CAST(0 AS INTEGER) AS epoch_id, "
    f"transit IS NOT NULL AS is_valid, round({TRIO_VALUE}, 4) + 0.0 AS prediction, "
    "CAST(date AS TIMESTAMP) AS event_time, CASE WHEN transit IS NULL THEN 'missing transit' END AS reject_reason "
    "FROM mobility, trio"
)


def _comparable(scored):
    """Without the creation time and the raw text; times without zone."""
    return rounded(
        scored.drop("created_at", "raw_value", "message_id", "stream_id").withColumn("event_time", F.col("event_time").cast("timestamp_ntz")), 4
    )


@query("t1_score_batch", sql(_SCORED_SQL, FIT_TRIO))
def t1(spark, sf_dir):
    return _comparable(score_batch(_messages(spark, sf_dir), 0, trained(spark, sf_dir)))


@query("k5_micro_batch_sink", sql(_SCORED_SQL, FIT_TRIO))
def k5(spark, sf_dir):
    return _comparable(_scored_store(spark, sf_dir).staged())


@query(
    "k2_write_staging",
    sql(f"SELECT * EXCLUDE (reject_reason) FROM ({_SCORED_SQL}) WHERE is_valid", FIT_TRIO),
)
def k2(spark, sf_dir):
    store = FileStore(spark, new_folder(spark, "store"))
    store.write_batch(score_batch(_messages(spark, sf_dir), 0, trained(spark, sf_dir)), 0)
    return _comparable(accepted(store.staged()))


@query(
    "t8_quarantine",
    sql(
        "SELECT CAST(0 AS INTEGER) AS epoch_id, 'missing transit' AS reject_reason, date, country_region AS country "
        "FROM mobility WHERE transit IS NULL"
    ),
)
def t8(spark, sf_dir):
    refused = _scored_store(spark, sf_dir).quarantined()
    original = parse_messages(refused, "raw_value")
    return original.select("epoch_id", "reject_reason", "json.data.date", "json.data.country")


@query(
    "t7_epoch_and_time",
    sql("SELECT CAST(0 AS INTEGER) AS epoch_id, count(*) AS n, true AS all_stamped FROM mobility"),
)
def t7(spark, sf_dir):
    staged = _scored_store(spark, sf_dir).staged()
    return staged.groupBy("epoch_id").agg(
        F.count("*").alias("n"), F.every(F.col("created_at").isNotNull()).alias("all_stamped")
    )


@query(
    "t11_latency_of_table",
    "SELECT epoch_id, count(*) AS n, quantile_disc(s, 0.5) AS p50_seconds, quantile_disc(s, 0.95) AS p95_seconds, "
    "max(s) AS max_seconds FROM (SELECT CAST(l_suppkey % 7 AS INTEGER) AS epoch_id, "
    "CAST(l_linenumber * 3600 AS DOUBLE) AS s FROM lineitem) GROUP BY epoch_id",
)
def t11_table(spark, sf_dir):
    """Every row takes as many hours as its line number."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_suppkey % 7 AS INT) AS epoch_id",
        "CAST(l_shipdate AS TIMESTAMP) AS event_time",
        "CAST(l_shipdate AS TIMESTAMP) + l_linenumber * INTERVAL '1' HOUR AS created_at",
    )
    return latency(rows)


@query("t11_latency")
def t11(spark, sf_dir):
    return latency(_scored_store(spark, sf_dir).staged())


_FLAT_SQL = (
    "SELECT 'mobility' AS type, CAST(date AS TIMESTAMP) AS event_time, date, country_region AS country, "
    f"{metric_doubles()} FROM mobility"
)


def _flat(messages):
    flat = flatten_message(parse_messages(messages)).drop("raw_value", "malformed", "message_id")
    return flat.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("k3_publish", sql(_FLAT_SQL))
def k3(spark, sf_dir):
    cfg = MessageConfig(folder=new_folder(spark, "messages"))
    publish(_messages(spark, sf_dir), cfg)
    return _flat(spark.read.text(cfg.folder))


@query("t13_replay", sql(_FLAT_SQL))
def t13(spark, sf_dir):
    cfg = MessageConfig(folder=new_folder(spark, "messages"))
    finish(start_replay(_message_stream(spark, sf_dir), cfg, new_folder(spark, "checkpoint")))
    return _flat(spark.read.text(cfg.folder))


@query(
    "t13_replay_rejects",
    sql(
        "SELECT CASE l_linenumber WHEN 1 THEN 'retail' WHEN 2 THEN 'date,transit' ELSE 'sent' END AS outcome, count(*) AS n FROM lineitem GROUP BY 1 "
        "UNION ALL SELECT 'observed as read', count(*) FROM lineitem "
        "UNION ALL SELECT 'observed as rejected', count(*) FROM lineitem WHERE l_linenumber <= 2"
    ),
)
def t13_rejects(spark, sf_dir):
    """A table of texts, replayed: cells that do not convert keep their row out, counted and set aside."""
    root, n = new_folder(spark, "text-table"), F.col("l_linenumber")
    rows = as_mobility(table(spark, sf_dir, "lineitem"), "l_shipdate", "l_linenumber")
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("date", *METRICS)})
    rows = rows.withColumn("retail", F.when(n == 1, "n/a").otherwise(F.col("retail")))
    rows.withColumns({c: F.when(n == 2, "soon").otherwise(F.col(c)) for c in ("date", "transit")}).write.parquet(root)
    cfg, rejects = MessageConfig(folder=new_folder(spark, "messages")), new_folder(spark, "rejects")
    # A quarter of the files at a time: the number of batches does not grow with the table.
    limit = math.ceil(list_parquet_files(spark, root).count() / 4)
    checked = checked_rows(stream_table(spark, root, max_files_per_trigger=limit))
    with ProgressLog(spark, new_folder(spark, "progress")) as log:
        sent = finish(start_replay(messages_of(checked, F.col("l_shipdate")), cfg, new_folder(spark, "checkpoint")))
        finish(start_refused(checked, rejects, new_folder(spark, "checkpoint")))
        log.wait(sent)
    refused = spark.read.parquet(rejects).groupBy(F.col("reject_reason").alias("outcome")).agg(F.count("*").alias("n"))
    arrived = _flat(spark.read.text(cfg.folder)).where("date IS NOT NULL").select(F.lit("sent").alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n"))
    seen = log.batches().where(F.col("query_id") == str(sent.id)).select("observed")
    sums = [
        seen.agg(F.sum(F.col("observed")[f"replay.{c}"]).alias("n")).select(F.lit(f"observed as {w}").alias("outcome"), "n")
        for c, w in (("n_read", "read"), ("n_rejected", "rejected"))
    ]
    return refused.unionByName(arrived).unionByName(sums[0]).unionByName(sums[1])


@query("t11_progress", "SELECT CAST(l_linenumber - 1 AS BIGINT) AS batch_id, count(*) AS n_input FROM lineitem GROUP BY 1")
def t11_progress(spark, sf_dir):
    """More batches than the query's own list keeps: as many files, and so a batch, for each line number."""
    root = new_folder(spark, "table")
    n_numbers, n_files = _write_in_turn(spark, table(spark, sf_dir, "lineitem"), root)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        with ProgressLog(spark, new_folder(spark, "progress"), every=3) as log:
            messages = _lineitem_messages(stream_table(spark, root, max_files_per_trigger=n_files))
            done = finish(start_batches(messages, _Keep(spark, "received"), new_folder(spark, "checkpoint")))
            log.wait(done)
        if len(done.recentProgress) >= n_numbers:
            raise AssertionError("the query's own list was to be shorter than its run")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    return log.batches().where("n_input > 0").select("batch_id", "n_input")


def _write_in_turn(spark, rows, root: str, at_most: int = 1_000_000) -> tuple[int, int]:
    """One append for each line number, in order, all of the same number of files; returns the numbers and the files of each.

    The number with the most rows has at most about ``at_most`` of them in a file. Files without rows
    make up for numbers with fewer rows than files.
    """
    counts = {r[0]: r["n"] for r in rows.groupBy("l_linenumber").agg(F.count("*").alias("n")).orderBy("l_linenumber").collect()}
    n_files = math.ceil(max(counts.values(), default=1) / at_most)
    for i, k in enumerate(counts, 1):
        rows.where(F.col("l_linenumber") == k).repartition(n_files).write.mode("append").parquet(root)
        for _ in range(i * n_files - list_parquet_files(spark, root).count()):
            rows.limit(0).coalesce(1).write.mode("append").parquet(root)
    return len(counts), n_files


class _Keep:
    """Micro-batch handler writing each batch to its own folder."""

    def __init__(self, spark, label: str):
        self.spark = spark
        self.folder = new_folder(spark, label)

    def __call__(self, batch, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/epoch_id={batch_id}")

    def rows(self):
        return self.spark.read.parquet(self.folder)


@query("s5_message_stream", sql(_FLAT_SQL))
def s5(spark, sf_dir):
    cfg = MessageConfig(folder=new_folder(spark, "messages"))
    publish(_messages(spark, sf_dir), cfg)
    keep = _Keep(spark, "received")
    finish(start_batches(mobility_stream(spark, cfg), keep, new_folder(spark, "checkpoint")))
    return _flat(keep.rows())


@query(
    "t2_restart",
    sql(
        "SELECT CAST(CASE WHEN date < DATE '1998-01-01' THEN 0 ELSE 1 END AS INTEGER) AS epoch_id, count(*) AS n "
        "FROM mobility GROUP BY 1"
    ),
)
def t2(spark, sf_dir):
    """Three runs on one checkpoint: early rows, then late rows, then nothing new."""
    cfg = MessageConfig(folder=new_folder(spark, "messages"))
    checkpoint, keep = new_folder(spark, "checkpoint"), _Keep(spark, "received")
    lineitem = table(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate").cast("date") < F.lit("1998-01-01").cast("date")
    for part in (lineitem.where(early), lineitem.where(~early), None):
        if part is not None:
            publish(_lineitem_messages(part), cfg)
        finish(start_batches(mobility_stream(spark, cfg), keep, checkpoint))
    return keep.rows().groupBy("epoch_id").agg(F.count("*").alias("n"))


@query("t4_update_without_aggregation", "SELECT event_id, event_type, value FROM events")
def t4(spark, sf_dir):
    table(spark, sf_dir, "events")
    keep = _Keep(spark, "received")
    events = stream_table(spark, f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    finish(start_batches(events, keep, new_folder(spark, "checkpoint")))
    return keep.rows().drop("epoch_id")


@query("t10_graceful_stop", "SELECT count(*) AS n, false AS is_active FROM events")
def t10(spark, sf_dir):
    """An unbounded query is drained, stopped and leaves whole batches."""
    table(spark, sf_dir, "events")
    keep = _Keep(spark, "received")
    events = stream_table(spark, f"{sf_dir}/events.parquet")
    running = start_batches(events, keep, new_folder(spark, "checkpoint"), interval="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return keep.rows().agg(F.count("*").alias("n")).withColumn("is_active", F.lit(running.isActive))


@query("t12_rate_limit", sql("SELECT count(*) AS n, true AS within_limit FROM mobility"))
def t12(spark, sf_dir):
    """At most a quarter of the table's files per batch."""
    root = new_folder(spark, "table")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lineitem = table(spark, sf_dir, "lineitem")
    lineitem.repartitionByRange(n_parts, "l_orderkey", "l_linenumber").write.parquet(root)
    n_files = list_parquet_files(spark, root).count()
    limit = math.ceil(n_files / 4)
    keep = _Keep(spark, "received")
    limited = _lineitem_messages(stream_table(spark, root, max_files_per_trigger=limit))
    finish(start_batches(limited, keep, new_folder(spark, "checkpoint")))
    per_batch = keep.rows().groupBy("epoch_id").agg(F.count("*").alias("n"))
    return per_batch.agg(
        F.sum("n").alias("n"), (F.count("*") == math.ceil(n_files / limit)).alias("within_limit")
    )


def _as_windows(events):
    return events.select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("country"),
        "value",
    )


def _event_windows(events, watermark=None):
    return windows.window_metrics(_as_windows(events), watermark=watermark, metrics=("value",))


def _plain(df):
    """Window bounds without zone, means rounded."""
    return rounded(
        df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    )


_WINDOW_SQL = (
    "SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start, "
    "time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS window_end, event_type AS country, "
    "count(*) AS n, round(avg(value), 6) + 0.0 AS avg_value FROM events GROUP BY ALL"
)


@query("t5_window_metrics", _WINDOW_SQL)
def t5(spark, sf_dir):
    return _plain(_event_windows(table(spark, sf_dir, "events")))


@query("t5_window_metrics_stream", _WINDOW_SQL)
def t5_stream(spark, sf_dir):
    table(spark, sf_dir, "events")
    folder, checkpoint = new_folder(spark, "windows"), new_folder(spark, "checkpoint")
    stream = _event_windows(stream_table(spark, f"{sf_dir}/events.parquet"), windows.WINDOW)
    finish(windows.start_changing_windows(stream, folder, checkpoint))
    return _plain(windows.current_windows(spark, folder))


@query("t5_window_table", _WINDOW_SQL)
def t5_table(spark, sf_dir):
    """Events in the order of their time, a sixth in each batch: the table's windows, open and closed, equal one run over all."""
    events, root = table(spark, sf_dir, "events"), new_folder(spark, "events")
    lo, hi = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    sixth = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - lo) * 6 / (hi - lo + 1))
    for k in range(6):
        events.where(sixth == k).coalesce(1).write.mode("append").parquet(root)
    kept = windows.WindowTable(spark, new_folder(spark, "windows"), every=4)
    stream = _event_windows(stream_table(spark, root, max_files_per_trigger=1), windows.WINDOW)
    finish(windows.start_window_table(stream, kept, new_folder(spark, "checkpoint")))
    still_open, everything = kept.open_windows(), kept.current()
    if len({f.rsplit("/", 2)[0] for f in still_open.inputFiles()}) != 1 or still_open.count() * 2 > everything.count():
        raise AssertionError("the open windows are to be few, and in one folder")
    return _plain(everything)


_MESSAGE_WINDOW_SQL = sql(
    "SELECT CAST(date AS TIMESTAMP) AS window_start, CAST(date AS TIMESTAMP) + INTERVAL '15 minutes' AS window_end, "
    "country_region AS country, count(*) AS n, "
    + ", ".join(f"round(avg({m}), 6) + 0.0 AS avg_{m}" for m in METRICS)
    + " FROM mobility GROUP BY date, country_region"
)


@query("t5_message_windows", _MESSAGE_WINDOW_SQL)
def t5_messages(spark, sf_dir):
    """All six metrics, from message text to windows."""
    flat = flatten_message(parse_messages(_messages(spark, sf_dir)))
    return _plain(windows.window_metrics(flat))


@query("t5_message_windows_stream", _MESSAGE_WINDOW_SQL)
def t5_messages_stream(spark, sf_dir):
    """The same from a message stream, taking each window's latest state."""
    folder, checkpoint = new_folder(spark, "windows"), new_folder(spark, "checkpoint")
    flat = flatten_message(parse_messages(_message_stream(spark, sf_dir)))
    found = windows.window_metrics(flat, watermark=windows.WINDOW)
    finish(windows.start_changing_windows(found, folder, checkpoint))
    return _plain(windows.current_windows(spark, folder))


@query(
    "t8_untimed_messages",
    "SELECT reject_reason, count(*) AS n FROM (SELECT CASE l_linenumber WHEN 1 THEN 'no readable time' "
    "WHEN 2 THEN 'malformed' END AS reject_reason FROM lineitem WHERE l_linenumber <= 2) GROUP BY 1",
)
def t8_untimed(spark, sf_dir):
    """A stream in which first lines have an unreadable time, second lines lost their end and the others are whole."""
    cfg = MessageConfig(folder=new_folder(spark, "messages"))
    rows, n = as_mobility(table(spark, sf_dir, "lineitem"), "l_shipdate", *KEY), F.col("l_linenumber")
    whole = F.col("value")
    spoilt = ((n == 1, F.regexp_replace(whole, '"timestamp":"[^"]*"', '"timestamp":"soon"')), (n == 2, F.substr(whole, F.lit(1), F.length(whole) - 1)))
    for rule, text in (*spoilt, (n > 2, whole)):
        publish(to_message(rows.where(rule), F.col("l_shipdate"), KEY).select(text.alias("value")), cfg)
    folder = new_folder(spark, "rejects")
    flat = flatten_message(parse_messages(mobility_stream(spark, cfg)))
    finish(windows.start_untimed(flat, folder, new_folder(spark, "checkpoint")))
    return spark.read.parquet(folder).groupBy("reject_reason").agg(F.count("*").alias("n"))


@query(
    "t6_watermark",
    f"SELECT * FROM ({_WINDOW_SQL}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '15 minutes'",
)
def t6(spark, sf_dir):
    """Only windows the watermark has passed leave an appending stream."""
    table(spark, sf_dir, "events")
    folder, checkpoint = new_folder(spark, "windows"), new_folder(spark, "checkpoint")
    stream = _event_windows(stream_table(spark, f"{sf_dir}/events.parquet"), windows.WINDOW)
    finish(windows.start_closed_windows(stream, folder, checkpoint))
    return _plain(spark.read.parquet(folder))


_PROMOTED = (
    "promoted AS (SELECT date, country_region AS country, CAST(residential AS DOUBLE) AS residential, "
    f"{_VECTOR} AS features_json, 'LinearRegression' AS model, epoch_id, round({TRIO_VALUE}, 4) + 0.0 AS prediction, "
    "CAST(date AS TIMESTAMP) AS event_time, true AS is_valid FROM "
    f"(SELECT {', '.join(f'{e} AS {c}' for c, e in MOBILITY.items())}, "
    "CAST(CASE WHEN l_linenumber <= 3 THEN 0 ELSE 1 END AS INTEGER) AS epoch_id FROM lineitem), trio "
    "WHERE transit IS NOT NULL)"
)


def _promoted_store(spark, sf_dir) -> FileStore:
    """Two epochs staged and promoted in turn; then one promotion with nothing new."""
    lineitem = table(spark, sf_dir, "lineitem")
    store = FileStore(spark, new_folder(spark, "store"))
    model = trained(spark, sf_dir)
    for epoch, part in enumerate(("l_linenumber <= 3", "l_linenumber > 3")):
        store.write_batch(score_batch(_lineitem_messages(lineitem.where(part)), epoch, model), epoch)
        store.promote()
    if store.promote() != 0:
        raise AssertionError("promoting without new epochs must change nothing")
    return store


@query("t9_promote", sql("SELECT * FROM promoted", f"{FIT_TRIO}, {_PROMOTED}"))
def t9(spark, sf_dir):
    return _comparable(_promoted_store(spark, sf_dir).predictions())


@query(
    "t9_promote_rows",
    sql(
        "SELECT date, country, model, residential, epoch_id, created_at, is_valid FROM (SELECT *, row_number() OVER "
        "(PARTITION BY date, country, model ORDER BY epoch_id DESC, created_at DESC, residential DESC) AS rank_in_key "
        "FROM predictions WHERE is_valid) WHERE rank_in_key = 1"
    ),
)
def t9_rows(spark, sf_dir):
    """Promotion of a staged table, applied a second time to its own result."""
    staged = predictions(spark, sf_dir)
    keys = ("date", "country", "model")
    once = promote_rows(staged, keys=keys)
    return promote_rows(staged, once, keys)


_SUMS = "count(*) AS n, CAST(sum(residential) AS DOUBLE) AS total"


def _sums(rows, *keys):
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("residential").alias("total"))


@query(
    "t9_two_models",
    sql(
        f"SELECT model, {_SUMS} FROM mobility, (SELECT unnest(['LinearRegression', 'Second']) AS model) "
        "WHERE transit IS NOT NULL GROUP BY model"
    ),
)
def t9_models(spark, sf_dir):
    """Two models over the same messages, each with a batch 0, in one store."""
    store, model = FileStore(spark, new_folder(spark, "store")), trained(spark, sf_dir)
    cfg = MessageConfig(folder=new_folder(spark, "messages"), compression="gzip")
    publish(_messages(spark, sf_dir), cfg)
    for name in ("LinearRegression", "Second"):
        stream = stream_name("checkpoint", name)
        store.write_batch(score_batch(spark.read.text(cfg.folder), 0, model, name, stream_id=stream), 0, stream)
    store.promote()
    return _sums(store.predictions(), "model")


_BATCHES = 12


@query(
    "t9_many_batches",
    sql(
        f"SELECT CAST(l_suppkey % {_BATCHES} AS INTEGER) AS epoch_id, {_SUMS} FROM (SELECT {', '.join(f'{e} AS {c}' for c, e in MOBILITY.items())}, "
        "l_suppkey FROM lineitem) WHERE transit IS NOT NULL GROUP BY 1"
    ),
)
def t9_batches(spark, sf_dir):
    """Many batches with a promotion after every fifth; reading commits and manifest opens few files."""
    store, model = FileStore(spark, new_folder(spark, "store"), every=4), trained(spark, sf_dir)
    lineitem = table(spark, sf_dir, "lineitem")
    for i in range(_BATCHES):
        part = lineitem.where(F.col("l_suppkey") % _BATCHES == i)
        store.write_batch(score_batch(_lineitem_messages(part), i, model), i)
        if i % 5 == 4:
            store.promote()
    store.promote()
    if len(store.commits.rows().inputFiles()) + len(store.manifest.rows().inputFiles()) > 2 * 2 * store.commits.every:
        raise AssertionError("commits and manifest must be read from snapshots and few entries")
    return _sums(store.predictions(), "epoch_id")


@query(
    "t9_promotions_at_once",
    sql(
        f"SELECT CAST(l_suppkey % 4 AS INTEGER) AS epoch_id, {_SUMS} FROM (SELECT {', '.join(f'{e} AS {c}' for c, e in MOBILITY.items())}, "
        "l_suppkey FROM lineitem) WHERE transit IS NOT NULL GROUP BY 1"
    ),
)
def t9_at_once(spark, sf_dir):
    """Four writers stage a batch each and promote at once, all touching the same months."""
    root, model = new_folder(spark, "store"), trained(spark, sf_dir)
    lineitem = table(spark, sf_dir, "lineitem")

    def write_and_promote(i: int) -> None:
        store = FileStore(spark, root)
        part = lineitem.where(F.col("l_suppkey") % 4 == i)
        store.write_batch(score_batch(_lineitem_messages(part), i, model), i)
        store.promote()

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write_and_promote, range(4)))
    return _sums(FileStore(spark, root).predictions(), "epoch_id")


@query(
    "t9_overlapping_batches",
    sql(
        f"SELECT CAST(CASE WHEN l_linenumber >= 4 THEN 1 ELSE 0 END AS INTEGER) AS epoch_id, {_SUMS} FROM (SELECT {', '.join(f'{e} AS {c}' for c, e in MOBILITY.items())}, "
        "l_linenumber FROM lineitem) WHERE transit IS NOT NULL GROUP BY 1"
    ),
)
def t9_overlapping(spark, sf_dir):
    """Two batches that share the messages of every fourth line; the later one's rows are kept."""
    store, model = FileStore(spark, new_folder(spark, "store")), trained(spark, sf_dir)
    lineitem = table(spark, sf_dir, "lineitem")
    for i, part in enumerate(("l_linenumber <= 4", "l_linenumber >= 4")):
        store.write_batch(score_batch(_lineitem_messages(lineitem.where(part)), i, model), i)
        store.promote()
    return _sums(store.predictions(), "epoch_id")


_HALVES = sql(
    f"SELECT part, {_SUMS} FROM (SELECT *, CASE WHEN transit IS NULL THEN NULL WHEN odd THEN 'late' ELSE 'early' END AS part FROM "
    f"(SELECT {', '.join(f'{e} AS {c}' for c, e in MOBILITY.items())}, l_linenumber > 3 AS odd FROM lineitem)) "
    "WHERE part IS NOT NULL GROUP BY part"
)


@query("t9_new_checkpoint", _HALVES)
def t9_checkpoint(spark, sf_dir):
    """Batch 0 of a first checkpoint promoted, then batch 0 of a second one."""
    store, model = FileStore(spark, new_folder(spark, "store")), trained(spark, sf_dir)
    lineitem = table(spark, sf_dir, "lineitem")
    for stream, part in (("early", "l_linenumber <= 3"), ("late", "l_linenumber > 3")):
        scored = score_batch(_lineitem_messages(lineitem.where(part)), 0, model, stream_id=stream)
        store.write_batch(scored, 0, stream)
        store.promote()
    return _sums(store.predictions(), F.col("stream_id").alias("part"))


@query("t9_partial_epoch", sql(f"SELECT {_SUMS} FROM mobility WHERE transit IS NOT NULL"))
def t9_partial(spark, sf_dir):
    """Half a batch without a commit counts for nothing; half a batch committed is replaced by the whole one."""
    store, model = FileStore(spark, new_folder(spark, "store")), trained(spark, sf_dir)
    lineitem = table(spark, sf_dir, "lineitem")
    half = score_batch(_lineitem_messages(lineitem.where("l_linenumber <= 3")), 0, model)
    store._write_attempt(half, 0, "batch")
    if store.promote() != 0:
        raise AssertionError("a batch without a commit must not be promoted")
    store.write_batch(half, 0)
    store.promote()
    store.write_batch(score_batch(_lineitem_messages(lineitem), 0, model), 0)
    store.promote()
    return _sums(store.predictions())


@query(
    "t8_invalid_messages",
    sql(
        "SELECT reject_reason, count(*) AS n FROM (SELECT CASE l_linenumber WHEN 1 THEN 'missing country' "
        "WHEN 2 THEN 'missing date' WHEN 3 THEN 'type other' WHEN 4 THEN 'missing type,date' END AS reject_reason "
        "FROM lineitem WHERE l_linenumber <= 4) GROUP BY 1"
    ),
)
def t8_invalid(spark, sf_dir):
    """Messages without country, date or type, or of another type, are refused with their reason."""
    rows = as_mobility(table(spark, sf_dir, "lineitem").where("l_linenumber <= 4"), "l_shipdate", *KEY)
    n = F.col("l_linenumber")
    rows = rows.withColumn("country_region", F.when(n != 1, F.col("country_region")))
    rows = rows.withColumn("date", F.when(~n.isin(2, 4), F.col("date"))).withColumn("transit", F.coalesce("transit", F.lit(0)))
    other, none = '"type":"other"', '"type":null'
    plain = '"type":"mobility"'
    text = [
        to_message(rows.where(n == i), F.col("l_shipdate"), KEY).select(F.replace("value", F.lit(plain), F.lit(to)).alias("value"))
        for i, to in ((1, plain), (2, plain), (3, other), (4, none))
    ]
    messages = text[0].unionByName(text[1]).unionByName(text[2]).unionByName(text[3])
    refused = score_batch(messages, 0, trained(spark, sf_dir)).where("NOT is_valid")
    return refused.groupBy("reject_reason").agg(F.count("*").alias("n"))


@query(
    "s6_read_predictions",
    sql(
        "SELECT date, residential, prediction FROM promoted WHERE country = 'country_A'",
        f"{FIT_TRIO}, {_PROMOTED}",
    ),
)
def s6(spark, sf_dir):
    rows = by_country(_promoted_store(spark, sf_dir).predictions(), "country_A")
    return rounded(rows.select("date", "residential", "prediction"), 4)
