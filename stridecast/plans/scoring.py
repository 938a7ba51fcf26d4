"""Messages to prediction rows: the same function for tables and micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.functions.messages import MESSAGE_TYPE, features_json, flatten_message, parse_messages
from stridecast.functions.values import all_present
from stridecast.operators.regression import as_pipeline, contract_of, score
from stridecast.schema import METRICS, PREDICTION_COLUMNS, SCORED_SCHEMA

MODEL_NAME = "LinearRegression"


def _reject_reason(flat: DataFrame, features) -> Column:
    """Why a message is refused: the one rule for tables and streams. Date, country, type and all features must be there."""
    wanted = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("type", "date", "country")]
    missing = F.concat_ws(",", *wanted, *[F.when(~all_present(flat, [f]), F.lit(f)) for f in features])
    return (
        F.when(F.col("raw_value").isNull(), "empty message")
        .when(F.col("malformed"), "malformed message")
        .when(F.col("type") != MESSAGE_TYPE, F.concat(F.lit("type "), F.col("type")))
        .when(missing != "", F.concat(F.lit("missing "), missing))
    )


def score_batch(
    messages: DataFrame,
    batch_id: int,
    model=None,
    model_name: str = MODEL_NAME,
    features=None,
    stream_id: str = "batch",
) -> DataFrame:
    """One scored row per message, valid or not, in a single pass without Python.

    Without a model the feature vector is the six metrics and the prediction is
    NULL. Invalid rows keep their raw text and a reason, and never stop the batch.
    """
    flat = flatten_message(parse_messages(messages))
    pipeline = None if model is None else as_pipeline(model, features)
    inputs = METRICS if pipeline is None else contract_of(pipeline).features
    if pipeline is None:
        scored = flat.withColumn("prediction", F.lit(None).cast("double"))
    else:
        scored = score(pipeline, flat)
    reason = _reject_reason(scored, inputs)
    vector = F.array(*[F.col(c) for c in inputs])
    return (
        scored.withColumns(
            {
                "reject_reason": reason,
                "is_valid": reason.isNull(),
                "features_json": features_json(vector, len(inputs)),
                "model": F.lit(model_name),
                "epoch_id": F.lit(batch_id).cast("int"),
                "stream_id": F.lit(stream_id),
                "created_at": F.current_timestamp(),
            }
        )
        .withColumn("raw_value", F.when(~F.col("is_valid"), F.col("raw_value")))
        .select(*SCORED_SCHEMA.fieldNames())
    )


def accepted(scored: DataFrame) -> DataFrame:
    return scored.where("is_valid").select(*PREDICTION_COLUMNS)


def quarantine(scored: DataFrame) -> DataFrame:
    """Refused messages with reason and original text."""
    return scored.where("NOT is_valid").select(
        "epoch_id", "reject_reason", "raw_value", "event_time", "created_at"
    )
