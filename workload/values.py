"""Projections, conversions, messages, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridecast.functions import messages, times, vectors
from stridecast.functions.values import try_double
from stridecast.operators import filters
from stridecast.schema import METRICS
from workload.registry import query
from workload.views import (
    MOBILITY,
    as_mobility,
    metric_doubles,
    mobility,
    mobility_long,
    predictions,
    sql,
    table,
)

_ALL = ", ".join(MOBILITY)


@query(
    "f1_date_parts",
    sql(
        'SELECT place_id, date, CAST(year(date) AS INTEGER) AS "année", CAST(month(date) AS INTEGER) AS mois, '
        "CAST(day(date) AS INTEGER) AS jour FROM mobility"
    ),
)
def f1(spark, sf_dir):
    return times.with_date_parts(mobility(spark, sf_dir).select("place_id", "date"))


@query("f2_short_metric_names", sql(f"SELECT {_ALL} FROM mobility"))
def f2(spark, sf_dir):
    return messages.short_metric_names(mobility_long(spark, sf_dir))


def _messages(spark, sf_dir):
    """Messages of the whole view; the ship time stands for the sending time."""
    rows = as_mobility(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return messages.to_message(rows, F.col("l_shipdate"))


_DOUBLES = metric_doubles()


@query(
    "f3_flatten_message",
    sql(
        "SELECT 'mobility' AS type, CAST(date AS TIMESTAMP) AS event_time, date, country_region AS country, "
        f"{_DOUBLES} FROM mobility"
    ),
)
def f3(spark, sf_dir):
    flat = messages.flatten_message(messages.parse_messages(_messages(spark, sf_dir)))
    return flat.drop("raw_value", "malformed", "message_id").withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")
    )


@query("f4_drop_columns", sql(f"SELECT {', '.join(c for c in MOBILITY if c != 'parks')} FROM mobility"))
def f4(spark, sf_dir):
    return mobility(spark, sf_dir).drop("parks")


@query(
    "f5_feature_columns",
    sql(
        "SELECT grocery, parks, transit, workplaces, residential FROM mobility"
    ),
)
def f5(spark, sf_dir):
    rows = mobility(spark, sf_dir)
    barred = ["country_region_code", "country_region", "place_id", "date", "retail"]
    return rows.select(*vectors.feature_columns(rows, barred))


@query(
    "f6_f8_literals_conditions",
    sql(
        "SELECT place_id, date, 'LinearRegression' AS model, CAST(6 AS INTEGER) AS size, "
        "CASE WHEN transit IS NOT NULL THEN true ELSE false END AS has_transit "
        "FROM mobility WHERE transit IS NOT NULL OR parks IS NOT NULL"
    ),
)
def f6_f8(spark, sf_dir):
    rows = mobility(spark, sf_dir).where(F.col("transit").isNotNull() | F.col("parks").isNotNull())
    return rows.select(
        "place_id",
        "date",
        F.lit("LinearRegression").alias("model"),
        F.lit(6).alias("size"),
        F.when(F.col("transit").isNotNull(), True).otherwise(False).alias("has_transit"),
    )


@query(
    "f9_casts",
    sql(
        "SELECT CAST(residential AS DOUBLE) AS as_double, CAST(residential AS VARCHAR) AS as_text, "
        "TRY_CAST(country_region AS DOUBLE) AS no_number, TRY_CAST(place_id AS DOUBLE) AS place_number FROM mobility"
    ),
)
def f9(spark, sf_dir):
    return mobility(spark, sf_dir).select(
        F.col("residential").cast("double").alias("as_double"),
        F.encode("residential", "UTF-8").cast("string").alias("as_text"),
        try_double(F.col("country_region")).alias("no_number"),
        try_double(F.col("place_id")).alias("place_number"),
    )


@query(
    "f10_parse_dates",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_orderdate AS order_time, "
    "CAST(NULL AS DATE) AS bad_date FROM orders",
)
def f10(spark, sf_dir):
    """Dates and times written as text, then parsed; a status code is no date."""
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("t"),
        "o_orderstatus",
    )
    return text.select(
        "o_orderkey",
        times.parse_date(F.col("d")).alias("order_date"),
        times.parse_time(F.col("t")).cast("timestamp_ntz").alias("order_time"),
        times.parse_date(F.col("o_orderstatus")).alias("bad_date"),
    )


@query(
    "f11_iso_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso_micros "
    "FROM events",
)
def f11(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.iso_text(F.col("ts")).alias("iso"),
        times.iso_micros_text(F.col("ts")).alias("iso_micros"),
    )


@query("f12_minute_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events")
def f12(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.minute_text(F.col("ts")).alias("minute"))


@query(
    "f13_created_at",
    sql("SELECT place_id, date, true AS is_stamped FROM mobility"),
)
def f13(spark, sf_dir):
    stamped = mobility(spark, sf_dir).withColumn("created_at", F.current_timestamp())
    return stamped.select("place_id", "date", F.col("created_at").isNotNull().alias("is_stamped"))


_STAMP = "'T00:00:00'"
_MESSAGE_SQL = (
    "to_json(struct_pack(type := 'mobility', \"timestamp\" := strftime(CAST(date AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%f'), "
    f"data := struct_pack(date := CAST(date AS VARCHAR) || {_STAMP}, country := country_region, "
    "metrics := struct_pack(" + ", ".join(f"{m} := CAST({m} AS DOUBLE)" for m in METRICS) + "))))"
)


@query("f16_to_message", sql(f"SELECT CAST({_MESSAGE_SQL} AS VARCHAR) AS value FROM mobility"))
def f16(spark, sf_dir):
    return _messages(spark, sf_dir)


@query(
    "f14_parse_messages",
    sql(
        "SELECT CAST(json_extract_string(value, '$.data.country') AS VARCHAR) AS country, "
        "CAST(json_extract_string(value, '$.data.metrics.transit') AS DOUBLE) AS transit, "
        "CAST(json_extract_string(value, '$.data.metrics.residential') AS DOUBLE) AS residential FROM messages",
        f"messages AS (SELECT {_MESSAGE_SQL} AS value FROM mobility)",
    ),
)
def f14(spark, sf_dir):
    parsed = messages.parse_messages(_messages(spark, sf_dir))
    return parsed.select("json.data.country", "json.data.metrics.transit", "json.data.metrics.residential")


@query(
    "f14_parse_props",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def f14_props(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@query(
    "f15_features_json",
    sql(
        "SELECT place_id, date, CAST(to_json(struct_pack(type := 'vector', size := 6, \"values\" := ["
        + ", ".join(f"CAST({m} AS DOUBLE)" for m in METRICS)
        + "])) AS VARCHAR) AS features_json FROM mobility"
    ),
)
def f15(spark, sf_dir):
    vector = F.array(*[F.col(m).cast("double") for m in METRICS])
    rows = mobility(spark, sf_dir)
    return rows.select("place_id", "date", messages.features_json(vector, len(METRICS)).alias("features_json"))


_PAIR = ("grocery", "residential")
_PAIR_SQL = sql("SELECT place_id, date, CAST(grocery AS DOUBLE) AS f0, CAST(residential AS DOUBLE) AS f1 FROM mobility")


@query("f17_vector_to_array", _PAIR_SQL)
def f17(spark, sf_dir):
    rows = vectors.assemble(mobility(spark, sf_dir), _PAIR)
    array = vectors.features_array()
    return rows.select("place_id", "date", array[0].alias("f0"), array[1].alias("f1"))


@query("u1_vector_to_array_in_sql", _PAIR_SQL)
def u1(spark, sf_dir):
    rows = vectors.with_arrays(vectors.assemble(mobility(spark, sf_dir), _PAIR))
    return spark.sql("SELECT place_id, date, features_array[0] AS f0, features_array[1] AS f1 FROM {rows}", rows=rows)


_P = "date, country, residential, model"


@query("f18_by_country", sql(f"SELECT {_P} FROM predictions WHERE country = 'country_A'"))
def f18(spark, sf_dir):
    return filters.by_country(predictions(spark, sf_dir), "country_A").select(*_P.split(", "))


@query(
    "f19_between_dates",
    sql(f"SELECT {_P} FROM predictions WHERE date BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'"),
)
def f19(spark, sf_dir):
    rows = filters.between_dates(predictions(spark, sf_dir), "1996-03-01", "1998-06-30")
    return rows.select(*_P.split(", "))


@query("f20_by_model", sql(f"SELECT {_P} FROM predictions WHERE model = 'RandomForest'"))
def f20(spark, sf_dir):
    return filters.by_model(predictions(spark, sf_dir), "RandomForest").select(*_P.split(", "))


@query("f21_at_least", sql(f"SELECT {_P} FROM predictions WHERE residential >= 10"))
def f21(spark, sf_dir):
    return filters.at_least(predictions(spark, sf_dir), 10).select(*_P.split(", "))


@query(
    "f18_f21_composed",
    sql(
        f"SELECT {_P} FROM predictions WHERE country = 'country_N' AND date BETWEEN DATE '1996-01-01' "
        "AND DATE '1999-12-31' AND model = 'LinearRegression' AND residential >= 5.5"
    ),
)
def composed(spark, sf_dir):
    rows = filters.select_rows(
        predictions(spark, sf_dir),
        country="country_N",
        dates=("1996-01-01", "1999-12-31"),
        model="LinearRegression",
        threshold=5.5,
    )
    return rows.select(*_P.split(", "))
