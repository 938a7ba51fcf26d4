"""Starting and stopping queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def with_trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Continuous runs every ``interval``, or one bounded run over what is there now."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def start_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Micro-batch sink. A batch that is repeated after a failure keeps its batch id."""
    writer = (
        stream.writeStream.foreachBatch(handle)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, interval).start()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for the query and always stop it, also on an interrupt or a failed batch."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        if query.isActive:
            query.stop()
    return query
