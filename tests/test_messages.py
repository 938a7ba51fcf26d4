"""Literal messages, validity and scoring of what arrives on the wire."""

import datetime as dt
import json

from pyspark.sql import functions as F

from stridecast.functions.messages import flatten_message, parse_messages, to_message
from stridecast.plans.scoring import accepted, quarantine, score_batch
from stridecast.schema import METRICS, MOBILITY_SCHEMA

GOOD = (
    '{"type":"mobility","timestamp":"2024-01-01T00:00:00.123","data":{"date":"2021-03-04T00:00:00",'
    '"country":"Morocco","metrics":{"retail":1.0,"residential":-2}}}'
)
NAN = (
    '{"type":"mobility","data":{"date":"2021-03-04","country":"Morocco",'
    '"metrics":{"retail":NaN,"residential":null}}}'
)
GARBAGE = "garbage"
WRONG = '{"type":"x","data":{"date":"bad","country":"Z","metrics":{"retail":"abc"}}}'
FULL = json.dumps(
    {
        "type": "mobility",
        "timestamp": "2024-01-01T10:20:30",
        "data": {
            "date": "2021-03-04",
            "country": "Morocco",
            "metrics": {m: float(i) for i, m in enumerate(METRICS)},
        },
    }
)


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_literal_messages(spark):
    rows = flatten_message(parse_messages(frame(spark, GOOD, NAN, GARBAGE, WRONG, None))).collect()
    day = dt.date(2021, 3, 4)
    seen = [(r["date"], r["country"], r["retail"], r["residential"], r["malformed"]) for r in rows]
    assert seen == [
        (day, "Morocco", 1.0, -2.0, False),
        (day, "Morocco", None, None, False),
        (None, None, None, None, True),
        (None, "Z", None, None, True),
        (None, None, None, None, False),
    ]
    assert rows[0]["event_time"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert rows[1]["event_time"] is None


def test_bytes_are_read_like_text(spark):
    binary = frame(spark, FULL).select(F.encode("value", "UTF-8").alias("value"))
    row = flatten_message(parse_messages(binary)).first()
    assert (row["country"], row["residential"], row["raw_value"]) == ("Morocco", 5.0, FULL)


def test_unreadable_event_time_is_null(spark):
    row = flatten_message(parse_messages(frame(spark, FULL.replace("2024-01-01T10:20:30", "soon")))).first()
    assert row["event_time"] is None and row["country"] == "Morocco" and not row["malformed"]


def test_message_keeps_nulls_and_missing_columns(spark):
    row = ("MA", "Morocco", "p", None, 1, None, 3, 4, 5, 6)
    table = spark.createDataFrame([row], MOBILITY_SCHEMA).drop("parks_percent_change_from_baseline")
    when = F.lit("2024-05-06 07:08:09").cast("timestamp")
    text = json.loads(to_message(table, when).first()["value"])
    assert text == {
        "type": "mobility",
        "timestamp": "2024-05-06T07:08:09.000000",
        "data": {
            "date": None,
            "country": "Morocco",
            "metrics": {
                "retail": 1.0,
                "grocery": None,
                "parks": None,
                "transit": 4.0,
                "workplaces": 5.0,
                "residential": 6.0,
            },
        },
    }


def test_nan_is_sent_as_null(spark):
    table = spark.sql("SELECT DATE'2021-01-01' AS date, 'X' AS country, double('NaN') AS retail")
    assert json.loads(to_message(table).first()["value"])["data"]["metrics"]["retail"] is None


def test_scoring_without_model_carries_all_six_metrics(spark):
    row = accepted(score_batch(frame(spark, FULL), 7)).first()
    assert json.loads(row["features_json"]) == {
        "type": "vector",
        "size": 6,
        "values": [0.0, 1.0, 2.0, 3.0, 4.0, 5.0],
    }
    assert (row["epoch_id"], row["model"], row["residential"]) == (7, "LinearRegression", 5.0)
    assert row["prediction"] is None and row["is_valid"] and row["created_at"] is not None


def test_bad_messages_are_set_aside_with_their_text(spark):
    scored = score_batch(frame(spark, FULL, NAN, GARBAGE, WRONG, None), 1)
    assert accepted(scored).count() == 1
    refused = {r["raw_value"]: r["reject_reason"] for r in quarantine(scored).collect()}
    assert refused == {
        NAN: "missing retail,grocery,parks,transit,workplaces,residential",
        GARBAGE: "malformed message",
        WRONG: "malformed message",
        None: "empty message",
    }
