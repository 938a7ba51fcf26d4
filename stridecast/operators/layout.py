"""Ordering, distribution and reuse of a frame."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.schema import DATE_PARTS

_TIE = "_row_position"


def sort_splitting_ties(df: DataFrame, *keys) -> DataFrame:
    """Global stable sort that can spread one key value over many tasks.

    A range sort keeps equal keys in one partition, so a key held by a third of
    the rows would fill one task. The row position in the input breaks ties and
    lets the range boundaries fall inside such a key. Apply it to a table scan
    (with filters), where that position is the same on every attempt.
    """
    return (
        df.withColumn(_TIE, F.monotonically_increasing_id()).orderBy(*keys, F.col(_TIE)).drop(_TIE)
    )


def sort_by_date_parts(df: DataFrame) -> DataFrame:
    return sort_splitting_ties(df, *DATE_PARTS)


def gather_by(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows with equal ``columns`` together before a partitioned write.

    Rebalancing hashes on the columns, then splits partitions above the advisory
    size and merges small ones, so one hot month does not become one task.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def top_rows(df: DataFrame, n: int, *keys) -> DataFrame:
    """The first ``n`` rows in key order; each task keeps only ``n`` candidates."""
    return df.orderBy(*keys).limit(n)


def sample_rows(df: DataFrame, n: int = 7, keys=("date",)) -> DataFrame:
    return top_rows(df, n, *keys)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` for the block's actions and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
