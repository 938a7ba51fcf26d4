"""Exact running totals and quantiles that never put a whole group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stridecast.functions.values import present
from stridecast.scratch import written


def join_same(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; key columns come from the left side."""
    if not keys:
        raise ValueError("join_same needs at least one key")
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, match, how).drop(*[f"_r_{k}" for k in keys])


def value_counts(df: DataFrame, keys, value: str) -> DataFrame:
    """One row per key and distinct value with its frequency; map-side combined."""
    return df.where(present(df, value)).groupBy(*keys, value).agg(F.count("*").alias("freq"))


def in_chunks(counts: DataFrame, keys, order: str, weight: str) -> DataFrame:
    """Written copy of ``counts`` cut into numbered chunks along (keys, order).

    ``counts`` holds one row per key and ``order`` value, so a range partitioning
    cuts even a very large group into even chunks. Writing them fixes the chunk
    numbers for everything computed from this table.
    """
    return written(
        counts.select(*keys, order, weight)
        .repartitionByRange(*keys, order)
        .withColumn("_chunk", F.spark_partition_id()),
        "chunks",
    )


def running_totals(chunks: DataFrame, keys, order: str, weight: str) -> DataFrame:
    """Per key in ``order``: the weight before each row (``before``) and in all (``total``).

    Takes the result of :func:`in_chunks`. Only chunk sums, at most one per
    partition and key, are accumulated per key; rows are accumulated per chunk.
    """
    keys = list(keys)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunks.groupBy(*keys, "_chunk")
        .agg(F.sum(weight).alias("_sum"))
        .select(
            *keys,
            "_chunk",
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_sum").over(Window.partitionBy(*keys)).alias("total"),
        )
    )
    inside = (
        Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return join_same(chunks, offsets, [*keys, "_chunk"]).select(
        *keys,
        order,
        weight,
        (F.col("_offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0))).alias("before"),
        "total",
    )


def _value_at(rank: Column, value: str) -> Column:
    held = (F.col("before") <= rank) & (rank < F.col("before") + F.col("freq"))
    return F.max(F.when(held, F.col(value).cast("double")))


def quantiles_of_counts(chunks: DataFrame, keys, value: str, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles from value counts laid out by :func:`in_chunks`."""
    ranked = running_totals(chunks, keys, value, "freq")
    position = {name: (F.col("total") - 1) * F.lit(float(p)) for name, p in probs.items()}
    sides = []
    for name, at in position.items():
        sides.append(_value_at(F.floor(at), value).alias(f"_lo_{name}"))
        sides.append(_value_at(F.ceil(at), value).alias(f"_hi_{name}"))
    edges = ranked.groupBy(*keys).agg(
        F.max("total").alias("total"),
        F.min(value).cast("double").alias("min_value"),
        F.max(value).cast("double").alias("max_value"),
        *sides,
    )

    def between(name: str) -> Column:
        lo, hi, at = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), position[name]
        return (lo + (hi - lo) * (at - F.floor(at))).alias(name)

    return edges.select(
        *keys,
        F.col("total").alias("n"),
        "min_value",
        *[between(name) for name in probs],
        "max_value",
    )


def exact_quantiles(df: DataFrame, keys, value: str, probs: dict[str, float]) -> DataFrame:
    """``keys``, n, min_value, one column per named probability, max_value."""
    return quantiles_of_counts(in_chunks(value_counts(df, keys, value), keys, value, "freq"), keys, value, probs)
