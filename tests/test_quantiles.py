"""Quantiles, box plots, histograms against brute force, with one hot group."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridecast.operators import serving
from stridecast.operators.quantiles import exact_quantiles, in_chunks, running_totals, value_counts


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one group; one group key is NULL; values repeat."""
    rng = np.random.default_rng(5)
    rows = []
    for key, n in (("hot", 4000), ("a", 500), (None, 37), ("one", 1), ("two", 2)):
        values = np.round(rng.normal(0, 100, n), 1)
        rows += [(key, "m", float(v)) for v in values]
    rows += [("hot", "m", None), ("hot", "m", float("nan"))]
    return rows


@pytest.fixture(scope="module")
def frame(spark, skewed):
    return spark.createDataFrame(skewed, "country string, model string, residential double").repartition(6)


def groups(skewed):
    seen = {}
    for key, _, v in skewed:
        if v is not None and v == v:
            seen.setdefault(key, []).append(v)
    return seen


def test_hot_group_spans_chunks(spark, frame, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    counts = value_counts(frame, ["country"], "residential")
    chunks = in_chunks(counts, ["country"], "residential", "freq")
    assert chunks.where("country = 'hot'").select("_chunk").distinct().count() > 2


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_exact_quantiles(frame, skewed, settings, coalesce):
    settings(spark__sql__adaptive__coalescePartitions__enabled=coalesce)
    probs = {"p10": 0.1, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    found = {r["country"]: r for r in exact_quantiles(frame, ["country"], "residential", probs).collect()}
    expected = groups(skewed)
    assert set(found) == set(expected)
    for key, values in expected.items():
        assert found[key]["n"] == len(values)
        for name, p in probs.items():
            assert found[key][name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_running_totals_without_keys(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 1000).select(F.col("id").alias("i"), (F.col("id") % 7).alias("w"))
    found = running_totals(in_chunks(rows, [], "i", "w"), [], "i", "w").orderBy("i").collect()
    weights = [i % 7 for i in range(1000)]
    assert [r["before"] for r in found] == list(np.cumsum([0] + weights[:-1]))
    assert {r["total"] for r in found} == {sum(weights)}


def test_box_stats(frame, skewed):
    found = {r["country"]: r for r in serving.box_stats(frame).collect()}
    for key, values in groups(skewed).items():
        q1, q3 = np.quantile(values, [0.25, 0.75])
        inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        assert found[key]["whisker_low"] == min(inside)
        assert found[key]["whisker_high"] == max(inside)
        assert (found[key]["min_value"], found[key]["max_value"]) == (min(values), max(values))


def test_box_points_keep_every_value(frame, skewed):
    points = serving.box_points(frame)
    assert points.count() == sum(len(v) for v in groups(skewed).values())
    stats = {r["country"]: r for r in serving.box_stats(frame).collect()}
    for r in points.where("country = 'hot'").collect():
        box = stats["hot"]
        outside = not box["whisker_low"] <= r["residential"] <= box["whisker_high"]
        assert r["is_outlier"] == outside


def test_approximate_box_is_close(frame, skewed):
    found = {r["country"]: r for r in serving.box_stats(frame, approximate=True).collect()}
    values = groups(skewed)["hot"]
    assert found["hot"]["n"] == len(values)
    assert found["hot"]["median"] == pytest.approx(np.median(values), abs=2)


def test_threshold_grid(frame, skewed):
    values = np.array([v for vs in groups(skewed).values() for v in vs])
    rows = serving.threshold_grid(frame, step=7.5).collect()
    assert len(rows) == int((values.max() - values.min()) / 7.5) + 1
    for r in rows:
        assert r["n_at_least"] == int((values >= r["threshold"]).sum())


def test_histogram_with_one_value(spark):
    rows = spark.createDataFrame([(4.0,), (4.0,)], "residential double")
    assert [(r["bin"], r["n"]) for r in serving.histogram(rows).collect()] == [(0, 2)]


def test_histogram_counts_all_values(frame, skewed):
    values = np.array([v for vs in groups(skewed).values() for v in vs])
    rows = serving.histogram(frame, bins=30).collect()
    lo, hi = values.min(), values.max()
    slots = np.minimum(np.floor((values - lo) / (hi - lo) * 30), 29)
    counts = np.bincount(slots.astype(int), minlength=30)
    assert {r["bin"]: r["n"] for r in rows} == {i: c for i, c in enumerate(counts) if c}


@pytest.mark.parametrize("job", [serving.histogram, serving.threshold_grid])
def test_no_values_give_no_rows(spark, job):
    empty = spark.createDataFrame([(None,)], "residential double")
    assert job(empty).count() == 0


def test_steps_agree_with_the_grid(spark):
    rows = spark.createDataFrame([(float(v),) for v in (-3.0, -2.75, 0.1, 0.1, 7.0, 7.2)] + [(None,), (float("nan"),)], "residential double")
    grid = {r["threshold"]: r["n_at_least"] for r in serving.threshold_grid(rows).collect()}
    steps = serving.threshold_steps(rows)
    held = {r["threshold"]: r["n_at_least"] for r in steps.collect()}
    assert held == {t: grid[t] for t in (-3.0, 0.0, 7.0)}
    assert all(serving.rows_at_least(steps, t) == n for t, n in grid.items()) and serving.rows_at_least(steps, 8.0) == 0
    assert serving.threshold_steps(rows.where("residential IS NULL")).collect() == []


def test_one_far_value_adds_one_step(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id = 7 THEN 1e12 ELSE id % 10 END AS residential")
    steps = serving.threshold_steps(rows).orderBy("threshold").collect()
    assert len(steps) == 11 and tuple(steps[-1]) == (1e12, 1) and steps[0]["n_at_least"] == 1000


def test_sketches_of_days_merge_to_the_quartiles_of_all(spark):
    rows = spark.range(0, 60_000, 1, 6).selectExpr(
        "date_add(date'2021-01-01', int(id % 50)) AS date",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 4) END AS country",
        "'m' AS model",
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') ELSE double(id * 7919 % 10007) END AS residential",
    )
    days = serving.day_sketches(rows)
    for dates in (None, ("2021-01-10", "2021-02-03")):
        kept = rows if dates is None else rows.where(F.col("date").between(*dates))
        exact = {r["country"]: r for r in serving.box_stats(kept).collect()}
        found = {r["country"]: r for r in serving.box_stats_of_days(days, dates).collect()}
        assert set(found) == set(exact) and len(found) == 5
        for country, box in found.items():
            assert all(box[c] == exact[country][c] for c in ("n", "min_value", "max_value"))
            assert all(abs(box[q] - exact[country][q]) < 0.015 * 10007 for q in serving.QUARTILES)


def test_day_sketches_combine_before_the_shuffle(spark):
    plan = serving.day_sketches(spark.sql("SELECT date'2021-01-01' AS date, 'a' AS country, 'm' AS model, 1.0D AS residential"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in text and "ObjectHashAggregate" in text
