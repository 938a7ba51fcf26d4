"""Queries behind the dashboard, over the predictions table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridecast.functions.times import minute_text
from stridecast.functions.values import present
from stridecast.operators.filters import at_least, between_dates, by_country
from stridecast.operators.layout import sort_splitting_ties, top_rows
from stridecast.operators.quantiles import (
    in_chunks,
    join_same,
    quantiles_of_counts,
    running_totals,
    value_counts,
)
from stridecast.schema import METRICS
from stridecast.scratch import empty_frame, written

BOX_KEYS = ("country", "model")
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def kpis(df: DataFrame, updated: str = "created_at") -> DataFrame:
    return df.agg(
        F.count("*").alias("total_predictions"),
        F.count_distinct("country").alias("countries"),
        minute_text(F.max(updated)).alias("last_update"),
    )


def countries(df: DataFrame) -> DataFrame:
    return df.select("country").distinct().orderBy("country")


def models(df: DataFrame) -> DataFrame:
    return df.select("model").distinct().orderBy("model")


def date_bounds(df: DataFrame, key: str = "country") -> DataFrame:
    return df.groupBy(key).agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def value_range(df: DataFrame, column: str):
    """(lowest, highest) present value as floats; (None, None) for no value. One job."""
    row = (
        df.where(present(df, column))
        .agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
        .first()
    )
    return row["lo"], row["hi"]


def threshold_grid(df: DataFrame, step: float = 0.5, column: str = "residential") -> DataFrame:
    """For each slider position from lowest to highest value, the rows at or above it."""
    lo, hi = value_range(df, column)
    spark = df.sparkSession
    if lo is None:
        return empty_frame(spark, T.StructType.fromDDL("threshold double, n_at_least long"))
    held = _slider_positions(df, lo, step, column)
    slots = spark.range(int((hi - lo) / step) + 1).select(F.col("id").alias("i"))
    filled = slots.join(held, "i", "left").select("i", F.coalesce("freq", F.lit(0)).alias("freq"))
    return _rows_at_or_above(filled, lo, step)


def _slider_positions(df: DataFrame, lo: float, step: float, column: str) -> DataFrame:
    """i and freq: the highest position at or below each value, with the number of rows there."""
    value = F.col(column).cast("double")

    def threshold(i):
        return F.lit(lo) + i * F.lit(float(step))

    # Division may land one step off the thresholds as they are reported.
    near = F.floor((value - lo) / step)
    position = (
        F.when(threshold(near) > value, near - 1).when(threshold(near + 1) <= value, near + 1).otherwise(near)
    )
    return df.where(present(df, column)).groupBy(position.alias("i")).agg(F.count("*").alias("freq"))


def _rows_at_or_above(held: DataFrame, lo: float, step: float) -> DataFrame:
    return running_totals(in_chunks(held, [], "i", "freq"), [], "i", "freq").select(
        (F.lit(lo) + F.col("i") * F.lit(float(step))).alias("threshold"),
        (F.col("total") - F.col("before")).alias("n_at_least"),
    )


def threshold_steps(df: DataFrame, step: float = 0.5, column: str = "residential") -> DataFrame:
    """:func:`threshold_grid` as a step function: only the positions that hold rows.

    Between two of them the count is that of the higher one, above the last it is 0. So the
    result grows with the different values, not with their range: one far value adds one row.
    """
    lo, _ = value_range(df, column)
    if lo is None:
        return empty_frame(df.sparkSession, T.StructType.fromDDL("threshold double, n_at_least long"))
    return _rows_at_or_above(_slider_positions(df, lo, step, column), lo, step)


def rows_at_least(steps: DataFrame, threshold: float) -> int:
    """How many rows reach a slider position, read from :func:`threshold_steps`."""
    return steps.where(F.col("threshold") >= threshold).agg(F.coalesce(F.max("n_at_least"), F.lit(0))).first()[0]


def daily_series(df: DataFrame, country: str, column: str = "residential") -> DataFrame:
    """Every row of one country in date order."""
    return sort_splitting_ties(by_country(df, country).select("date", column), "date")


def series_by_model(df: DataFrame, lo, hi, column: str = "residential") -> DataFrame:
    """Per day and model within the dates: stacked value and number of rows."""
    return (
        between_dates(df, lo, hi)
        .groupBy("date", "model")
        .agg(F.sum(column).alias("total"), F.count("*").alias("n"))
    )


def series_matrix(series: DataFrame, model_names, value: str = "total") -> DataFrame:
    """One column per model from :func:`series_by_model`."""
    return series.groupBy("date").pivot("model", list(model_names)).agg(F.first(value))


def histogram(df: DataFrame, column: str = "residential", bins: int = 30) -> DataFrame:
    """Equal-width bins between lowest and highest value; the last bin is closed.

    Bins without rows are absent. A column with one value has bin 0 only.
    """
    lo, hi = value_range(df, column)
    if lo is None:
        shape = T.StructType.fromDDL("bin int, bin_start double, bin_end double, n long")
        return empty_frame(df.sparkSession, shape)
    if hi == lo:
        slot, width = F.lit(0), 0.0
    else:
        scaled = F.floor((F.col(column).cast("double") - lo) / (hi - lo) * bins)
        slot, width = F.least(scaled, F.lit(bins - 1)).cast("int"), (hi - lo) / bins
    return (
        df.where(present(df, column))
        .groupBy(slot.alias("bin"))
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
            "n",
        )
    )


def _whiskers(values: DataFrame, boxes: DataFrame, keys, column: str) -> DataFrame:
    """Add the most extreme values within 1.5 interquartile ranges of the box."""
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    value = F.col(column).cast("double")
    inside = value.between(F.col("q1") - reach, F.col("q3") + reach)
    stats = [c for c in boxes.columns if c not in keys]
    return (
        join_same(values.select(*keys, column), boxes, keys)
        .groupBy(*keys, *stats)
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
        )
    )


def box_stats(
    df: DataFrame,
    column: str = "residential",
    keys=BOX_KEYS,
    approximate: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Quartiles (linear interpolation), extremes, count and whiskers per group.

    The exact form reduces the input once to distinct values with counts and
    works on those. ``approximate`` keeps a mergeable sketch per group instead.
    The small result of the quartile step is written, so the join that follows
    is a broadcast only where its real size allows one.
    """
    keys = list(keys)
    if approximate:
        seen = df.where(present(df, column))
        sketch = F.percentile_approx(F.col(column).cast("double"), list(QUARTILES.values()), accuracy)
        boxes = seen.groupBy(*keys).agg(
            F.count("*").alias("n"),
            F.min(column).cast("double").alias("min_value"),
            sketch.alias("_q"),
            F.max(column).cast("double").alias("max_value"),
        )
        boxes = boxes.select(
            *keys,
            "n",
            "min_value",
            *[F.col("_q")[i].alias(name) for i, name in enumerate(QUARTILES)],
            "max_value",
        )
        return _whiskers(seen, written(boxes, "boxes"), keys, column)
    counts = in_chunks(value_counts(df, keys, column), keys, column, "freq")
    boxes = written(quantiles_of_counts(counts, keys, column, QUARTILES), "boxes")
    return _whiskers(counts, boxes, keys, column)


def day_sketches(df: DataFrame, column: str = "residential", keys=BOX_KEYS, k: int = 400) -> DataFrame:
    """A quantile sketch with count and extremes for each date and group: the table to keep for :func:`box_stats_of_days`.

    Sketches are combined before the shuffle. ``k`` sets size and accuracy: 400 keeps a rank within
    about half a percent, in some 4 KB.
    """
    value = F.col(column).cast("double")
    return (
        df.where(present(df, column))
        .groupBy("date", *keys)
        .agg(
            F.count("*").alias("n"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.kll_sketch_agg_double(value, k).alias("sketch"),
        )
    )


def box_stats_of_days(days: DataFrame, dates=None, keys=BOX_KEYS, k: int = 400) -> DataFrame:
    """Count, extremes and approximate quartiles per group over all ``dates`` (first, last), from stored sketches.

    Rows of the source are not read again, and a day that is added costs its own sketch only.
    """
    if dates is not None:
        days = between_dates(days, *dates)
    merged = days.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("min_value").alias("min_value"),
        F.kll_merge_agg_double("sketch", k).alias("_all"),
        F.max("max_value").alias("max_value"),
    )
    quartiles = [F.kll_sketch_get_quantile_double("_all", F.lit(p)).alias(name) for name, p in QUARTILES.items()]
    return merged.select(*keys, "n", "min_value", *quartiles, "max_value")


def box_points(df: DataFrame, column: str = "residential", keys=BOX_KEYS) -> DataFrame:
    """All rows that carry a value, marked where they fall outside their group's whiskers."""
    keys = list(keys)
    fences = written(
        box_stats(df, column, keys).select(*keys, "whisker_low", "whisker_high"), "fences"
    )
    marked = join_same(df.where(present(df, column)), fences, keys)
    inside = F.col(column).between(F.col("whisker_low"), F.col("whisker_high"))
    return marked.withColumn("is_outlier", ~inside).drop("whisker_low", "whisker_high")


def preview(df: DataFrame, n: int = 50, keys=("date", "country")) -> DataFrame:
    return top_rows(df, n, *keys)


def risk_zones(df: DataFrame, threshold: float, column: str = "residential") -> DataFrame:
    """Countries by mean value over their rows at or above the threshold."""
    return (
        at_least(df, threshold, column)
        .groupBy("country")
        .agg(
            F.count("*").alias("n"),
            F.avg(column).alias("mean_value"),
            F.max(column).alias("max_value"),
        )
        .orderBy(F.desc("mean_value"), "country")
    )


def metric_trends(df: DataFrame, metrics=None) -> DataFrame:
    """Daily mean of each metric in long form; averaged first, then turned to rows.

    Without a list: the metrics the table has, since ingest may have pruned some.
    """
    metrics = metrics or [m for m in METRICS if m in df.columns]
    daily = df.groupBy("date").agg(*[F.avg(m).alias(m) for m in metrics])
    return daily.unpivot("date", list(metrics), "metric", "mean_value")


def heatmap(df: DataFrame, period: str = "month", column: str = "residential") -> DataFrame:
    """Mean per country and period (``month``, ``quarter`` or ``year``)."""
    return df.groupBy("country", F.trunc("date", period).alias("period")).agg(
        F.avg(column).alias("mean_value"), F.count("*").alias("n")
    )


def heatmap_matrix(df: DataFrame, column: str = "residential") -> DataFrame:
    """One row per country, one column per month of the year."""
    months = df.groupBy("country", F.month("date").alias("m")).agg(F.avg(column).alias("mean_value"))
    wide = months.groupBy("country").pivot("m", list(range(1, 13))).agg(F.first("mean_value"))
    return wide.withColumnsRenamed({str(m): f"month_{m:02d}" for m in range(1, 13)})
