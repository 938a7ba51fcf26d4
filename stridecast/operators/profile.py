"""Counts and column profiles, each from one aggregate over the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.functions.values import present


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def wide_counts(df: DataFrame) -> DataFrame:
    """One row: the row count and, per column, its non-null count."""
    counts = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return df.agg(F.count("*").alias("n_rows"), *counts)


def non_null_counts(df: DataFrame) -> DataFrame:
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null"), F.col("n_rows"))
        for i, c in enumerate(df.columns)
    ]
    return wide_counts(df).select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column; NaN counts as missing."""
    missing = [F.count_if(~present(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count"))
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*missing).select(F.inline(F.array(*cells)))


def describe_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of each column."""
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col(f"c{i}").alias("non_null"),
            F.col("n_rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return wide_counts(df).select(F.inline(F.array(*cells)))


def output_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
