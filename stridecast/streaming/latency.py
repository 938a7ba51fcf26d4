"""How long messages take from event to stored prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latency(scored: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Per epoch: messages, and median, 95th percentile and maximum delay in seconds.

    The percentiles come from a mergeable sketch, so a large batch is combined
    before the shuffle.
    """
    seconds = (F.unix_micros("created_at") - F.unix_micros("event_time")) / 1e6
    shares = F.percentile_approx(seconds, [0.5, 0.95], accuracy)
    return (
        scored.where(F.col("event_time").isNotNull())
        .groupBy("epoch_id")
        .agg(F.count("*").alias("n"), shares.alias("_p"), F.max(seconds).alias("max_seconds"))
        .select(
            "epoch_id",
            "n",
            F.col("_p")[0].alias("p50_seconds"),
            F.col("_p")[1].alias("p95_seconds"),
            "max_seconds",
        )
    )


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent batches of a query as Spark reports them (a bounded list).

    ``n_late`` counts the rows that came after their window had closed.
    """
    rows = [
        (
            p["batchId"],
            p["numInputRows"],
            p["durationMs"].get("triggerExecution"),
            sum(state["numRowsDroppedByWatermark"] for state in p["stateOperators"]),
        )
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, "batch_id long, n_input long, trigger_ms long, n_late long")
