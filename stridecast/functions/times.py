"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.schema import DATE_PARTS


def with_date_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add year, month and day-of-month columns used as partition directories."""
    year, month, day = DATE_PARTS
    return df.withColumns(
        {
            year: F.year(date_col),
            month: F.month(date_col),
            day: F.dayofmonth(date_col),
        }
    )


def parse_date(col: Column) -> Column:
    """Text to date; unreadable text becomes NULL."""
    return F.try_to_timestamp(col).cast("date")


def parse_time(col: Column) -> Column:
    """ISO text to timestamp; unreadable text becomes NULL."""
    return F.try_to_timestamp(col)


def iso_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")


def iso_micros_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def minute_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm")
