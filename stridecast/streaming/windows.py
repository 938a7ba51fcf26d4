"""Tumbling-window aggregates over event time."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stridecast.schema import METRICS
from stridecast.scratch import empty_frame
from stridecast.sources.ledger import Ledger, newest
from stridecast.streaming.runs import start_batches, with_trigger

WINDOW = "15 minutes"


def window_metrics(
    df: DataFrame,
    duration: str = WINDOW,
    watermark: str | None = None,
    time: str = "event_time",
    key: str = "country",
    metrics=METRICS,
) -> DataFrame:
    """Row count and mean of each metric per window and key, for tables and streams.

    With a watermark a stream closes windows, bounds its state and drops rows
    that come later than that. Counts and sums are combined before the shuffle,
    so one key holding most rows costs no more than the others.
    """
    if df.schema[time].dataType.simpleString() != "timestamp":
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    if watermark:
        df = df.withWatermark(time, watermark)
    return (
        df.groupBy(F.window(time, duration).alias("w"), key)
        .agg(F.count("*").alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in metrics])
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            key,
            "n",
            *[f"avg_{m}" for m in metrics],
        )
    )


def start_closed_windows(
    windows: DataFrame, folder: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Write each window once, when the watermark has passed its end."""
    writer = (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", folder)
    )
    return with_trigger(writer, interval).start()


def untimed(flat: DataFrame, time: str = "event_time") -> DataFrame:
    """Messages that belong to no window, as they were read, with the reason."""
    reason = F.when(F.col("malformed"), "malformed").otherwise("no readable time")
    return flat.where(F.col(time).isNull()).select("raw_value", reason.alias("reject_reason"))


def start_untimed(flat: DataFrame, folder: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Write the messages that windows leave out, each once. The source is read a second time for it."""
    writer = (
        untimed(flat)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", folder)
    )
    return with_trigger(writer, interval).start()


def start_changing_windows(
    windows: DataFrame, folder: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Write every window that a batch changed, in that batch's own folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return start_batches(windows, handle, checkpoint, interval)


def current_windows(spark: SparkSession, folder: str, key: str = "country") -> DataFrame:
    """The latest state of each window from :func:`start_changing_windows`."""
    rows = spark.read.parquet(folder)
    values = [c for c in rows.columns if c not in ("window_start", "window_end", key, "batch_id")]
    newest = rows.groupBy("window_start", "window_end", key).agg(
        F.max(F.struct("batch_id", *values)).alias("_newest")
    )
    return newest.select("window_start", "window_end", key, *[f"_newest.{c}" for c in values])


_TABLE_LOG = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.StringType())])


class WindowTable:
    """The current state of a stream's windows, updated batch by batch.

    Each batch writes one folder: the windows that can still change (those before it, replaced where
    the batch has them), and apart from them the windows that no later batch can change. Closed windows are written once
    and not read again by an update, so a batch costs as much as there are open windows.

    A window is closed when its end is ``delay`` or more before the start of the latest window that earlier
    batches held. The stream's watermark, with the same ``delay``, is then past its end, and later rows of it are
    dropped; a stream without that watermark must not be kept here. A batch that is repeated changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, delay: str = WINDOW, key: str = "country", every: int = 100):
        self.spark = spark
        self.root = root
        self.delay = F.expr(f"INTERVAL {delay}")
        self.identity = ("window_start", "window_end", key)
        self.log = Ledger(spark, f"{root}/log", _TABLE_LOG, lambda rows: newest(rows, ("batch_id",), "attempt"), every)

    def _folder(self, attempt: str, closed: bool) -> str:
        return f"{self.root}/attempt={attempt}/closed={str(closed).lower()}"

    def _read(self, attempts: list[str], closed: bool) -> DataFrame | None:
        """The windows of these attempts; None if there is none. An attempt without such windows has no folder."""
        folders = [self._folder(a, closed) for a in attempts]
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        places = [(f, jvm.org.apache.hadoop.fs.Path(f)) for f in folders]
        there = [f for f, place in places if place.getFileSystem(conf).exists(place)]
        return self.spark.read.parquet(*there) if there else None

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Take in the windows that a batch changed."""
        rows, turn = self.log.state()
        known = newest(rows, ("batch_id",), "attempt")
        if not known.where(F.col("batch_id") == batch_id).isEmpty():
            return
        last = known.where(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()
        before = self._read([last["attempt"]], False) if last else None
        if before is None:
            merged, horizon = batch, None
        else:
            horizon = before.agg(F.max("window_start")).first()[0]
            same = reduce(lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in self.identity])
            kept = before.alias("old").join(batch.select(*self.identity).alias("new"), same, "left_anti")
            merged = kept.unionByName(batch)
        closed = F.lit(False) if horizon is None else F.col("window_end") <= F.lit(horizon) - self.delay
        attempt = uuid.uuid4().hex
        marked = merged.withColumn("closed", closed).hint("rebalance", F.col("closed"))
        marked.write.partitionBy("closed").parquet(f"{self.root}/attempt={attempt}")
        self.log.append([{"batch_id": batch_id, "attempt": attempt}], after=turn)

    def _attempts(self) -> list[str]:
        """Attempts that count, by batch: one driver row for each batch."""
        known = newest(self.log.rows(), ("batch_id",), "attempt").orderBy("batch_id")
        return [r["attempt"] for r in known.collect()]

    def open_windows(self) -> DataFrame | None:
        """Windows that can still change: the last batch's folder, nothing else."""
        last = newest(self.log.rows(), ("batch_id",), "attempt").orderBy(F.desc("batch_id")).first()
        return self._read([last["attempt"]], False) if last else None

    def closed_windows(self) -> DataFrame | None:
        return self._read(self._attempts(), True)

    def current(self, schema: T.StructType | None = None) -> DataFrame:
        """All windows as they are now. ``schema`` serves a table without any."""
        parts = [p for p in (self.open_windows(), self.closed_windows()) if p is not None]
        if not parts:
            return empty_frame(self.spark, schema or T.StructType())
        return reduce(DataFrame.unionByName, parts)


def start_window_table(windows: DataFrame, table: WindowTable, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep ``table`` at the latest state of each window of a watermarked stream."""
    return start_batches(windows, table.update, checkpoint, interval)
