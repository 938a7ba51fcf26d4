"""Staged prediction rows to one current row per key."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.operators.layout import gather_by
from stridecast.scratch import written

#: A message scored by a model; several places share a country and a day.
PREDICTION_KEY = ("message_id", "model")
RECENCY = ("epoch_id", "created_at")


def latest_rows(df: DataFrame, keys=PREDICTION_KEY, recency=RECENCY) -> DataFrame:
    """Newest row per key by ``recency``; remaining columns break ties, so repeats agree.

    A maximum is combined before the shuffle, so a key with very many versions
    sends one row per task instead of gathering them all for a sort.
    """
    rest = [c for c in df.columns if c not in keys and c not in recency]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*recency, *rest)).alias("_newest"))
    return newest.select(*keys, "_newest.*").select(*df.columns)


#: Hashes of repeated keys that every task may hold: 8 MB as a file.
FEW = 1_000_000


def repeated_keys(df: DataFrame, keys=PREDICTION_KEY) -> DataFrame:
    """``_key``: 64-bit hashes of the keys that more than one row holds.

    It reads the key columns only and counts in a hash aggregate, combined before the shuffle. Two
    keys may share a hash; then both are named, which never leaves a repeated one out.
    """
    counted = df.select(F.xxhash64(*keys).alias("_key")).groupBy("_key").agg(F.count("*").alias("n"))
    return counted.where("n > 1").select("_key")


def latest_rows_of_files(
    df: DataFrame, keys=PREDICTION_KEY, recency=RECENCY, few: int = FEW, repeated: DataFrame | None = None
) -> DataFrame:
    """As :func:`latest_rows`, for rows that lie in files and whose keys seldom repeat.

    Rows that are alone under their key pass without a sort or a shuffle; the others are compared.
    Runs a job: the repeated keys are written first (unless given), so their number is known. With more
    than ``few`` they are not sent to the tasks, and all rows are compared.
    """
    repeated = written(repeated_keys(df, keys) if repeated is None else repeated, "repeated")
    n = repeated.count()
    if n == 0:
        return df
    if n > few:
        return latest_rows(df, keys, recency)
    hashed = df.withColumn("_key", F.xxhash64(*keys))
    alone = hashed.join(repeated, "_key", "left_anti").select(*df.columns)
    compared = hashed.join(repeated, "_key", "left_semi").select(*df.columns)
    return alone.unionByName(latest_rows(compared, keys, recency))


#: A key with more rows than this is compared apart, where versions are combined before the shuffle.
HOT = 1_000


def repeats_by_month(df: DataFrame, month: Column, keys=PREDICTION_KEY) -> DataFrame:
    """:func:`repeated_keys` with the number of rows ``n`` and the first and last ``month`` (a whole number) of each."""
    counted = df.select(F.xxhash64(*keys).alias("_key"), month.alias("_month")).groupBy("_key")
    sums = counted.agg(F.count("*").alias("n"), F.min("_month").alias("lo"), F.max("_month").alias("hi"))
    return sums.where("n > 1")


def _packed(df: DataFrame) -> DataFrame:
    """Hashes in ``message_id`` as 32 bytes in ``_id`` instead of 64 digits, which a shuffle cannot compress."""
    digits = F.when(F.col("message_id").rlike("^[0-9a-f]{64}$"), F.col("message_id"))
    packed = df.withColumn("_id", F.unhex(digits))
    return packed.withColumn("message_id", F.when(F.col("_id").isNull(), F.col("message_id")))


def _unpacked(df: DataFrame) -> DataFrame:
    return df.withColumn("message_id", F.coalesce("message_id", F.lower(F.hex("_id")))).drop("_id")


def gathered(df: DataFrame, group: str) -> DataFrame:
    """:func:`gather_by` with short message ids under way."""
    return _unpacked(gather_by(_packed(df), group))


#: Rows of one task that writes a range of dates: about the default advisory size in files.
TASK_ROWS = 1_000_000
#: Tasks of a range. A union of frames that are all one partition is one partition, in one task.
LEAST_TASKS = 2
#: Each range is a scan of its own in the plan.
MOST_RANGES = 200
#: Rows that a range finds in a file on average; with fewer, opening the files costs more than a shuffle.
LEAST_ROWS = 5_000


def month_counts(df: DataFrame, period: Column, month: Column) -> list:
    """One driver row for each month: ``period``, ``month``, rows ``n``, first and last day ``lo`` and ``hi`` (NULL without dates)."""
    day = F.unix_date("date")
    return df.groupBy(period.alias("period"), month.alias("month")).agg(F.count("*").alias("n"), F.min(day).alias("lo"), F.max(day).alias("hi")).collect()


def date_ranges(counts, rows: int, most: int = MOST_RANGES) -> list[tuple]:
    """``(lo, hi, n)`` of neighbouring months with together ``rows`` or more, the last with fewer; rows without a date by themselves."""
    dated = sorted((r["lo"], r["hi"], r["n"]) for r in counts if r["lo"] is not None)
    least = max(rows, math.ceil(sum(n for *_, n in dated) / most))
    ranges: list[tuple] = []
    for lo, hi, n in dated:
        if ranges and ranges[-1][2] < least:
            ranges[-1] = (ranges[-1][0], hi, ranges[-1][2] + n)
        else:
            ranges.append((lo, hi, n))
    undated = sum(r["n"] for r in counts if r["lo"] is None)
    return ranges + ([(None, None, undated)] if undated else [])


def gathered_of_files(df: DataFrame, group: str, counts, keys=PREDICTION_KEY) -> DataFrame:
    """As :func:`gathered`, for rows in files that are each in the order of their dates; ``counts`` come from :func:`month_counts`.

    Each range of dates is read from all files by few tasks, which skip the pages of other dates, so nothing
    is shuffled. Files with few rows of each range are shuffled instead. Files in another order are read whole for each range.
    Rows come in the order of ``keys``: the id that several models give their rows then takes little more room than once.
    """
    ranges = date_ranges(counts, LEAST_TASKS * TASK_ROWS)
    if sum(n for *_, n in ranges) < LEAST_ROWS * len(ranges) * len(df.inputFiles()):
        return gathered(df, group)

    def days(lo, hi) -> Column:
        if lo is None:
            return F.col("date").isNull()
        first, last = (F.date_from_unix_date(F.lit(d)) for d in (lo, hi))
        return (F.col("date") >= first) & (F.col("date") <= last)

    frames = [df.where(days(lo, hi)).coalesce(max(LEAST_TASKS, round(n / TASK_ROWS))) for lo, hi, n in ranges]
    return reduce(DataFrame.unionAll, frames).sortWithinPartitions(group, *keys)


def latest_rows_gathered(df: DataFrame, repeated: DataFrame, n: int, n_apart: int, group: str, keys=PREDICTION_KEY, recency=RECENCY, few: int = FEW) -> list[DataFrame]:
    """Frames that together are :func:`latest_rows` of ``df``, each with the rows of a ``group`` in few tasks.

    ``repeated`` comes from :func:`repeats_by_month` and has ``n`` rows, ``n_apart`` of them in several months or
    above ``HOT``. With at most ``few`` of them only their rows are compared. Beyond, rows are shuffled once, in ranges of group and key, and compared where they
    lie; only the keys apart are compared across ranges.
    """
    if n <= few or n_apart > few or "message_id" not in keys:
        return [gathered(latest_rows_of_files(df, keys, recency, few, repeated.select("_key")), group)]
    frames, hashed = [], df.withColumn("_key", F.xxhash64(*keys))
    if n_apart:
        apart = written(repeated.where((F.col("lo") != F.col("hi")) | (F.col("n") > HOT)).select("_key"), "apart")
        compared = hashed.join(apart, "_key", "left_semi").select(*df.columns)
        frames.append(gathered(latest_rows(compared, keys, recency), group))
        hashed = hashed.join(apart, "_key", "left_anti").select(*hashed.columns)
    ranged = _packed(hashed).repartitionByRange(group, "_key")
    frames.append(_unpacked(latest_rows(ranged, (group, "_key", "_id", *keys), recency)).select(*df.columns))
    return frames


def valid_rows(staging: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """The valid staged rows beside the current ones."""
    valid = staging.where("is_valid")
    return valid if current is None else current.select(*valid.columns).unionByName(valid)


def promote_rows(staging: DataFrame, current: DataFrame | None = None, keys=PREDICTION_KEY) -> DataFrame:
    """Current rows after taking in the valid staged rows. Applying it twice changes nothing."""
    return latest_rows(valid_rows(staging, current), keys)
