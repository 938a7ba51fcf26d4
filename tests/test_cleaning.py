"""Null rules at their edges."""

import math

from pyspark.sql import functions as F

from stridecast.operators import cleaning, filters, profile


def test_exactly_half_null_is_kept_and_more_is_dropped(spark):
    rows = spark.createDataFrame(
        [(1, 1, None), (2, None, None), (3, 3, None), (4, None, 4)], "a int, half int, sparse int"
    )
    assert cleaning.sparse_columns(rows) == (["sparse"], 4)
    assert cleaning.drop_sparse(rows).columns == ["a", "half"]


def test_empty_table_drops_nothing(spark):
    rows = spark.createDataFrame([], "a int, b int")
    assert cleaning.sparse_columns(rows) == ([], 0)
    assert profile.is_empty(rows)


def test_thin_rows_count_nan_as_missing(spark):
    rows = spark.createDataFrame([(1, 1.0, "x"), (2, math.nan, "y"), (3, None, None)], "a int, b double, c string")
    assert [r["a"] for r in cleaning.drop_thin_rows(rows, 3).collect()] == [1]
    assert sorted(r["a"] for r in cleaning.drop_thin_rows(rows, 2).collect()) == [1, 2]


def test_null_counts_see_nan_but_non_null_counts_do_not(spark):
    rows = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double")
    assert profile.null_counts(rows).first()["null_count"] == 2
    assert profile.non_null_counts(rows).first()["non_null"] == 2


def test_split_valid_names_every_failed_column(spark):
    rows = spark.createDataFrame(
        [("1", "2.5"), ("x", "2"), ("x", "y"), (None, "1")], "a string, b string"
    )
    good, bad = cleaning.split_valid(rows, {"a": "int", "b": "double"})
    assert sorted(good.collect(), key=str) == sorted([(1, 2.5), (None, 1.0)], key=str)
    assert good.dtypes == [("a", "int"), ("b", "double")]
    assert {(r["a"], r["b"]): r["reject_reason"] for r in bad.collect()} == {
        ("x", "2"): "a",
        ("x", "y"): "a,b",
    }


def test_flag_valid(spark):
    rows = spark.createDataFrame(
        [([1.0],), ([None],), ([math.nan],), (None,)], "features_array array<double>"
    )
    assert [r["is_valid"] for r in cleaning.flag_valid(rows).collect()] == [True, False, False, False]


def test_threshold_excludes_null_and_nan(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (math.nan,), (None,)], "residential double")
    assert [r[0] for r in filters.at_least(rows, 2).collect()] == [2.0]


def test_describe_columns(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "n int, s string")
    assert [tuple(r) for r in profile.describe_columns(rows).orderBy("position").collect()] == [
        (0, "n", "int", 1, 2),
        (1, "s", "string", 2, 2),
    ]


def test_output_stats_of_empty_table(spark):
    empty = spark.range(3).where(F.lit(False))
    assert tuple(profile.output_stats(empty).first()) == (0, 1)
