"""Dashboard filters, written so that they reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.functions.values import is_fractional
from stridecast.schema import DATE_PARTS


def _as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def by_country(df: DataFrame, country: str) -> DataFrame:
    return df.where(F.col("country") == country)


def by_model(df: DataFrame, model: str) -> DataFrame:
    return df.where(F.col("model") == model)


def between_dates(df: DataFrame, lo, hi) -> DataFrame:
    """Rows with ``lo <= date <= hi``.

    On a table partitioned by year and month the same bounds are repeated on the
    partition columns, because Spark does not derive them from ``date``.
    """
    lo, hi = _as_date(lo), _as_date(hi)
    kept = df.where(F.col("date").between(F.lit(lo), F.lit(hi)))
    year, month, _ = DATE_PARTS
    if year in df.columns:
        kept = kept.where(F.col(year).between(lo.year, hi.year))
        if month in df.columns:
            index = F.col(year) * 12 + F.col(month)
            kept = kept.where(index.between(lo.year * 12 + lo.month, hi.year * 12 + hi.month))
    return kept


def at_least(df: DataFrame, threshold: float, column: str = "residential") -> DataFrame:
    """Rows at or above the threshold; NULL and NaN never qualify."""
    kept = df.where(F.col(column) >= threshold)
    return kept.where(~F.isnan(column)) if is_fractional(df, column) else kept


def select_rows(df: DataFrame, country=None, dates=None, model=None, threshold=None) -> DataFrame:
    """All given filters together; the single filters keep their own scopes."""
    if country is not None:
        df = by_country(df, country)
    if dates is not None:
        df = between_dates(df, *dates)
    if model is not None:
        df = by_model(df, model)
    if threshold is not None:
        df = at_least(df, threshold)
    return df
