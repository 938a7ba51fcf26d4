"""Small value-level expressions shared by several operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def present(df: DataFrame, name: str) -> Column:
    """True where a value is neither NULL nor NaN."""
    col = F.col(name)
    return col.isNotNull() & ~F.isnan(col) if is_fractional(df, name) else col.isNotNull()


def all_present(df: DataFrame, names) -> Column:
    return reduce(lambda a, b: a & b, [present(df, n) for n in names])


def try_double(col: Column) -> Column:
    return col.try_cast("double")
