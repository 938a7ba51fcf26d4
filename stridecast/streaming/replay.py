"""A stored table played back as a message stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stridecast.functions.messages import short_metric_names, to_message
from stridecast.operators.cleaning import with_reject_reason
from stridecast.schema import METRICS
from stridecast.sources.files import stream_table
from stridecast.sources.kafka import MessageConfig, file_options, writer_options
from stridecast.streaming.runs import with_trigger

#: Name under which a checked replay observes its rows.
OBSERVED = "replay"


def message_stream(
    spark: SparkSession,
    root: str,
    event_time: Column | None = None,
    max_files_per_trigger: int | None = None,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    key=(),
) -> DataFrame:
    """Stream of ``value`` texts from the Parquet files below ``root``.

    Rows whose cells do not convert are left out, and every batch observes how many
    rows it read (``replay.n_read``) and left out (``replay.n_rejected``).
    """
    return messages_of(checked_rows(shape(stream_table(spark, root, max_files_per_trigger))), event_time, key)


def checked_rows(rows: DataFrame) -> DataFrame:
    """Rows with short metric names; text dates and metrics are converted, and ``reject_reason`` names those that do not.

    Columns that already have their type cannot fail. ``raw_value`` is the row as it was read, in JSON, where it is refused.
    """
    rows = short_metric_names(rows)
    wanted = {"date": "date", **{m: "double" for m in METRICS}}
    text = {c: t for c, t in wanted.items() if dict(rows.dtypes).get(c) == "string"}
    whole = rows.withColumn("raw_value", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}))
    checked = with_reject_reason(whole, text)
    return checked.withColumn("raw_value", F.when(F.col("reject_reason").isNotNull(), F.col("raw_value")))


def messages_of(checked: DataFrame, event_time: Column | None = None, key=()) -> DataFrame:
    """The message texts of the rows that convert; the others are counted, not sent."""
    refused = F.col("reject_reason").isNotNull()
    counts = (F.count(F.lit(1)).alias("n_read"), F.count_if(refused).alias("n_rejected"))
    return to_message(checked.observe(OBSERVED, *counts).where(~refused), event_time, key)


def refused_rows(checked: DataFrame) -> DataFrame:
    """The rows a replay leaves out: as they were read, with the reason."""
    return checked.where("reject_reason IS NOT NULL").select("raw_value", "reject_reason")


def start_refused(checked: DataFrame, folder: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Write each refused row once. The source is read a second time for it."""
    writer = (
        refused_rows(checked)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", folder)
    )
    return with_trigger(writer, interval).start()


def start_replay(
    messages: DataFrame, cfg: MessageConfig, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Send messages to the topic or folder; pace comes from the trigger and files per trigger."""
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if cfg.servers:
        writer = writer.format("kafka").options(**writer_options(cfg))
    else:
        writer = writer.format("text").options(path=cfg.folder, **file_options(cfg))
    return with_trigger(writer, interval).start()
