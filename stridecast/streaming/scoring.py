"""Scoring a message stream into a store."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stridecast.plans.scoring import MODEL_NAME, score_batch
from stridecast.streaming.runs import start_batches


def stream_name(checkpoint: str, model_name: str) -> str:
    """One stream of batch numbers: they start at 0 with each checkpoint, and each model has its own."""
    return f"{re.sub('[^A-Za-z0-9_.-]', '_', model_name)}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"


def start_scoring(
    stream: DataFrame,
    store,
    checkpoint: str,
    model=None,
    model_name: str = MODEL_NAME,
    features=None,
    interval: str | None = None,
) -> StreamingQuery:
    """Score each micro-batch and hand it to ``store.write_batch`` under its stream and batch id."""
    stream_id = stream_name(checkpoint, model_name)

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(score_batch(batch, batch_id, model, model_name, features, stream_id), batch_id, stream_id)

    return start_batches(stream, handle, checkpoint, interval)
