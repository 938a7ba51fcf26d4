"""Rows to nested JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridecast.functions.times import iso_micros_text, iso_text, parse_time
from stridecast.functions.values import nan_to_null
from stridecast.schema import (
    CORRUPT_COLUMN,
    LONG_TO_SHORT,
    MESSAGE_SCHEMA,
    METRICS,
    SHORT_TO_LONG,
)

MESSAGE_TYPE = "mobility"


def short_metric_names(df: DataFrame) -> DataFrame:
    """Rename the long metric columns that are present; other columns stay."""
    return df.withColumnsRenamed({k: v for k, v in LONG_TO_SHORT.items() if k in df.columns})


def long_metric_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in SHORT_TO_LONG.items() if k in df.columns})


def message_id(df: DataFrame, key) -> Column:
    """Stable id of a row: a hash of its key columns, NULL and empty text told apart."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in key]
    return F.sha2(F.concat_ws("\x1f", *parts).cast("binary"), 256)


def to_message(df: DataFrame, event_time: Column | None = None, key=()) -> DataFrame:
    """One JSON text per row in column ``value``.

    ``key`` names the columns that identify a row; their hash goes along as ``id``,
    by which promotion knows a message again. Without it the text itself is the identity.

    A metric the table no longer has, a NULL and a NaN all become JSON null, and
    null fields stay in the text.
    """
    rows = short_metric_names(df)
    country = "country" if "country" in rows.columns else "country_region"

    def metric(name: str) -> Column:
        value = F.col(name).cast("double") if name in rows.columns else F.lit(None).cast("double")
        return nan_to_null(value).alias(name)

    when = F.current_timestamp() if event_time is None else event_time
    body = F.struct(
        *([message_id(rows, key).alias("id")] if key else []),
        F.lit(MESSAGE_TYPE).alias("type"),
        iso_micros_text(when).alias("timestamp"),
        F.struct(
            iso_text(F.col("date")).alias("date"),
            F.col(country).cast("string").alias("country"),
            F.struct(*[metric(m) for m in METRICS]).alias("metrics"),
        ).alias("data"),
    )
    return rows.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Add struct column ``json``; text that does not fit the schema is kept in it.

    The parsed value goes through a one-element explode. Later filters on its
    fields stop there; below a plain column they would be pushed down together
    with a second copy of the parser.
    """
    schema = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select("*", F.explode(F.array(parsed)).alias("json"))


def flatten_message(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Flat row: id, type, event time, date, country, six metrics, and the raw text.

    A message without an id is identified by its text.
    """
    text = F.col(value).cast("string")
    star = parsed.select(
        text.alias("raw_value"),
        F.coalesce("json.id", F.sha2(text.cast("binary"), 256)).alias("message_id"),
        F.col(f"json.{CORRUPT_COLUMN}").isNotNull().alias("malformed"),
        F.col("json.type").alias("type"),
        parse_time(F.col("json.timestamp")).alias("event_time"),
        "json.data.*",
    )
    return star.select(
        "raw_value",
        "malformed",
        "message_id",
        "type",
        "event_time",
        "date",
        "country",
        *[nan_to_null(F.col(f"metrics.{m}")).alias(m) for m in METRICS],
    )


def features_json(values: Column, size: int) -> Column:
    """JSON text of a feature vector given as ``array<double>``."""
    body = F.struct(
        F.lit("vector").alias("type"),
        F.lit(size).alias("size"),
        values.alias("values"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})
