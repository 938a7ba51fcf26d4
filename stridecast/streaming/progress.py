"""What every micro-batch of a query read, dropped and observed, kept beyond the query's own short list."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from stridecast.sources.ledger import Ledger

_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("n_input", T.LongType()),
        T.StructField("n_late", T.LongType()),
        T.StructField("trigger_ms", T.LongType()),
        T.StructField("observed", T.MapType(T.StringType(), T.LongType())),
    ]
)
_KEY = ("query_id", "batch_id")


def _batches(rows: DataFrame) -> DataFrame:
    """One row for each batch: idle triggers report the last batch again, without rows."""
    values = [c for c in _SCHEMA.fieldNames() if c not in _KEY]
    best = F.max_by(F.struct(*values, "turn"), F.struct("n_input", "turn")).alias("_best")
    return rows.groupBy(*_KEY).agg(best).select(*_KEY, "_best.*")


class ProgressLog(StreamingQueryListener):
    """Listener that adds each batch's progress to a ledger. Use it as a context around the queries it is to follow.

    ``n_late`` counts the rows that came after their window had closed. ``observed`` holds the whole numbers that
    the query observes, as ``name.column``. The log outlives the query, the session and the driver.
    """

    def __init__(self, spark: SparkSession, root: str, every: int = 100):
        self.spark = spark
        self.ledger = Ledger(spark, root, _SCHEMA, _batches, every)
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {
            f"{name}.{field}": value
            for name, row in p.observedMetrics.items()
            for field, value in row.asDict().items()
            if isinstance(value, int) and not isinstance(value, bool)
        }
        row = {
            "query_id": str(p.id),
            "query_name": p.name,
            "batch_id": p.batchId,
            "n_input": p.numInputRows,
            "n_late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "trigger_ms": p.durationMs.get("triggerExecution"),
            "observed": observed,
        }
        self.ledger.append([row])

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all progress of an ended query is in the log; events reach listeners late, but in order."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.runId} was reported within {seconds} s")

    def batches(self) -> DataFrame:
        """query_id, batch_id, query_name, n_input, n_late, trigger_ms, observed of every batch."""
        return _batches(self.ledger.rows()).drop("turn")

    def totals(self) -> DataFrame:
        """Batches and rows of each query."""
        sums = [F.sum(c).alias(c) for c in ("n_input", "n_late")]
        return self.batches().groupBy("query_id").agg(F.count("*").alias("n_batches"), *sums)
