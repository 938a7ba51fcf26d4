"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridecast.operators import serving
from stridecast.operators.filters import at_least, by_country
from stridecast.operators.quantiles import exact_quantiles
from stridecast.scratch import written
from workload.registry import query
from workload.views import PREDICTIONS, mobility, predictions, sql, table


@query(
    "g1_kpis",
    sql(
        "SELECT count(*) AS total_predictions, count(DISTINCT country) AS countries, "
        "strftime(max(created_at), '%Y-%m-%d %H:%M') AS last_update FROM predictions"
    ),
)
def g1(spark, sf_dir):
    return serving.kpis(predictions(spark, sf_dir))


@query("g2_countries", sql("SELECT DISTINCT country FROM predictions ORDER BY country"))
def g2(spark, sf_dir):
    return serving.countries(predictions(spark, sf_dir))


@query("g3_models", sql("SELECT DISTINCT model FROM predictions ORDER BY model"))
def g3(spark, sf_dir):
    return serving.models(predictions(spark, sf_dir))


@query(
    "g4_date_bounds",
    sql("SELECT country, min(date) AS min_date, max(date) AS max_date FROM predictions GROUP BY country"),
)
def g4(spark, sf_dir):
    return serving.date_bounds(predictions(spark, sf_dir))


@query(
    "g5_threshold_grid",
    sql(
        "SELECT lo + i * 0.5::DOUBLE AS threshold, (SELECT count(*) FROM predictions WHERE residential >= lo + i * 0.5::DOUBLE) AS n_at_least "
        "FROM (SELECT lo, unnest(range(CAST(floor((hi - lo) / 0.5) AS BIGINT) + 1)) AS i "
        "FROM (SELECT min(residential) AS lo, max(residential) AS hi FROM predictions))"
    ),
)
def g5(spark, sf_dir):
    return serving.threshold_grid(predictions(spark, sf_dir))


_FAR = "CASE WHEN l_orderkey % 997 = 0 THEN 1000000000000 ELSE residential END"


@query(
    "g5_threshold_steps",
    sql(
        "SELECT lo + i * 0.5::DOUBLE AS threshold, CAST(sum(freq) OVER (ORDER BY i DESC) AS BIGINT) AS n_at_least FROM ("
        "SELECT lo, CAST(floor((v - lo) / 0.5) AS BIGINT) AS i, count(*) AS freq FROM (SELECT v, min(v) OVER () AS lo FROM "
        f"(SELECT CAST({_FAR.replace('residential', PREDICTIONS['residential'])} AS DOUBLE) AS v FROM lineitem)) GROUP BY ALL)"
    ),
)
def g5_steps(spark, sf_dir):
    """Values of a million million among small ones: a grid would have two million million positions."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", f"{PREDICTIONS['residential']} AS residential")
    return serving.threshold_steps(rows.selectExpr(f"CAST({_FAR} AS DOUBLE) AS residential"))


@query("g6_daily_series", sql("SELECT date, residential FROM predictions WHERE country = 'country_R' ORDER BY date"))
def g6(spark, sf_dir):
    return serving.daily_series(predictions(spark, sf_dir), "country_R")


_SPAN = "date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"


@query(
    "g7_series_by_model",
    sql(
        "SELECT date, model, sum(residential) AS total, count(*) AS n FROM predictions "
        f"WHERE country = 'country_A' AND {_SPAN} GROUP BY date, model"
    ),
)
def g7(spark, sf_dir):
    rows = by_country(predictions(spark, sf_dir), "country_A")
    return serving.series_by_model(rows, "1996-01-01", "1998-12-31")


@query(
    "g7_series_matrix",
    sql(
        "SELECT date, sum(CASE WHEN model = 'LinearRegression' THEN residential END) AS \"LinearRegression\", "
        "sum(CASE WHEN model = 'RandomForest' THEN residential END) AS \"RandomForest\" FROM predictions "
        f"WHERE {_SPAN} GROUP BY date"
    ),
)
def g7_matrix(spark, sf_dir):
    series = serving.series_by_model(predictions(spark, sf_dir), "1996-01-01", "1998-12-31")
    return serving.series_matrix(series, ["LinearRegression", "RandomForest"])


@query(
    "g8_histogram",
    sql(
        "SELECT bin, lo + bin * ((hi - lo) / 30) AS bin_start, lo + (bin + 1) * ((hi - lo) / 30) AS bin_end, count(*) AS n "
        "FROM (SELECT lo, hi, CAST(least(floor((residential - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin "
        "FROM (SELECT *, min(residential) OVER () AS lo, max(residential) OVER () AS hi FROM predictions "
        "WHERE model = 'LinearRegression')) GROUP BY bin, lo, hi"
    ),
)
def g8(spark, sf_dir):
    rows = predictions(spark, sf_dir).where(F.col("model") == "LinearRegression")
    return serving.histogram(rows)


_BOX_SQL = (
    "box AS (SELECT country, model, count(*) AS n, min(residential) AS min_value, "
    "quantile_cont(residential, 0.25) AS q1, quantile_cont(residential, 0.5) AS median, "
    "quantile_cont(residential, 0.75) AS q3, max(residential) AS max_value FROM predictions GROUP BY country, model), "
    "fenced AS (SELECT p.country, p.model, min(residential) AS whisker_low, max(residential) AS whisker_high "
    "FROM predictions p JOIN box b ON p.country = b.country AND p.model = b.model "
    "WHERE residential BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY p.country, p.model)"
)
_BOX_COLUMNS = "country, model, n, min_value, q1, median, q3, max_value, whisker_low, whisker_high"


@query("g9_box_stats", sql(f"SELECT {_BOX_COLUMNS} FROM box JOIN fenced USING (country, model)", _BOX_SQL))
def g9(spark, sf_dir):
    return serving.box_stats(predictions(spark, sf_dir))


# Extended prices take many distinct values, so that quartiles interpolate.
_PRICE_BOX = (
    "SELECT l_returnflag AS flag, count(*) AS n, min(l_extendedprice) AS min_value, "
    "round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, "
    "round(quantile_cont(l_extendedprice, 0.75), 6) AS q3, max(l_extendedprice) AS max_value "
    "FROM lineitem GROUP BY l_returnflag"
)


@query("g9_box_stats_many_values", _PRICE_BOX)
def g9_many(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_extendedprice")
    boxes = exact_quantiles(rows, ["flag"], "l_extendedprice", serving.QUARTILES)
    return boxes.withColumns({q: F.round(q, 6) for q in serving.QUARTILES})


# Within the sketch's accuracy a quartile is the smallest value that covers its share.
@query(
    "g9_box_stats_approximate",
    sql(
        f"SELECT {_BOX_COLUMNS} FROM box JOIN fenced USING (country, model)",
        _BOX_SQL.replace("quantile_cont", "quantile_disc"),
    ),
)
def g9_approximate(spark, sf_dir):
    return serving.box_stats(predictions(spark, sf_dir), approximate=True)


_SOME_DAYS = "date BETWEEN DATE '1994-03-01' AND DATE '1997-06-30'"


@query(
    "g9_box_stats_of_days",
    sql(
        "SELECT l_returnflag AS flag, count(*) AS n, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value, "
        f"true AS q1_close, true AS median_close, true AS q3_close FROM lineitem, (SELECT 1) WHERE {_SOME_DAYS.replace('date', 'CAST(l_shipdate AS DATE)', 1)} "
        "GROUP BY l_returnflag"
    ),
)
def g9_days(spark, sf_dir):
    """Sketches of days, stored, then merged over some years; quartiles are held against the true ranks."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_returnflag").alias("flag"), "l_extendedprice"
    )
    days = written(serving.day_sketches(rows, "l_extendedprice", ["flag"]), "day-sketches")
    boxes = written(serving.box_stats_of_days(days, ("1994-03-01", "1997-06-30"), ["flag"]), "boxes")
    price = F.col("l_extendedprice")
    ranks = rows.where(_SOME_DAYS).join(boxes, "flag").groupBy("flag", "n", "min_value", "max_value")
    shares = [x for q in serving.QUARTILES for x in (F.avg((price < F.col(q)).cast("int")).alias(f"{q}_below"), F.avg((price <= F.col(q)).cast("int")).alias(f"{q}_upto"))]
    close = [
        ((F.col(f"{q}_below") <= p + 0.01) & (F.col(f"{q}_upto") >= p - 0.01)).alias(f"{q}_close") for q, p in serving.QUARTILES.items()
    ]
    return ranks.agg(*shares).select("flag", "n", "min_value", "max_value", *close)


@query(
    "g10_box_points",
    sql(
        "SELECT p.date, country, model, residential, NOT (residential BETWEEN whisker_low AND whisker_high) AS is_outlier "
        "FROM predictions p JOIN fenced USING (country, model) WHERE residential >= 0",
        _BOX_SQL.replace("FROM predictions", "FROM kept").replace(
            "box AS (", "kept AS (SELECT * FROM predictions WHERE residential >= 0), box AS (", 1
        ),
    ),
)
def g10(spark, sf_dir):
    rows = predictions(spark, sf_dir).select("date", "country", "model", "residential")
    return serving.box_points(at_least(rows, 0))


_PREVIEW = ["date", "country", "residential", "model"]


@query(
    "g11_preview",
    sql(
        "SELECT date, country, residential, model FROM predictions WHERE model = 'RandomForest' "
        "ORDER BY date, country, residential, model LIMIT 50"
    ),
)
def g11(spark, sf_dir):
    rows = predictions(spark, sf_dir).where(F.col("model") == "RandomForest").select(*_PREVIEW)
    return serving.preview(rows, 50, _PREVIEW)


@query(
    "g12_risk_zones",
    sql(
        "SELECT country, count(*) AS n, round(avg(residential), 6) AS mean_value, max(residential) AS max_value "
        "FROM predictions WHERE residential >= 5 GROUP BY country"
    ),
)
def g12(spark, sf_dir):
    return serving.risk_zones(predictions(spark, sf_dir), 5).withColumn("mean_value", F.round("mean_value", 6))


@query(
    "g13_metric_trends",
    sql(
        " UNION ALL ".join(
            f"SELECT date, '{m}' AS metric, round(avg({m}), 6) AS mean_value FROM mobility GROUP BY date"
            for m in ("retail", "grocery", "parks", "transit", "workplaces", "residential")
        )
    ),
)
def g13(spark, sf_dir):
    return serving.metric_trends(mobility(spark, sf_dir)).withColumn("mean_value", F.round("mean_value", 6))


@query(
    "g14_heatmap",
    sql(
        "SELECT country, CAST(date_trunc('month', date) AS DATE) AS period, round(avg(residential), 6) AS mean_value, "
        "count(*) AS n FROM predictions GROUP BY ALL"
    ),
)
def g14(spark, sf_dir):
    return serving.heatmap(predictions(spark, sf_dir)).withColumn("mean_value", F.round("mean_value", 6))


@query(
    "g14_heatmap_matrix",
    sql(
        "SELECT country, "
        + ", ".join(
            f"round(avg(CASE WHEN month(date) = {m} THEN residential END), 6) AS month_{m:02d}" for m in range(1, 13)
        )
        + " FROM predictions GROUP BY country"
    ),
)
def g14_matrix(spark, sf_dir):
    wide = serving.heatmap_matrix(predictions(spark, sf_dir))
    return wide.select("country", *[F.round(c, 6).alias(c) for c in wide.columns if c != "country"])
