"""Column pruning, row filters and validity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.operators.profile import wide_counts


def sparse_columns(df: DataFrame, max_null: float = 0.5) -> tuple[list[str], int]:
    """Columns with a larger null share than ``max_null``, and the row count.

    One aggregate job whose single result row comes to the driver. A column at
    exactly the limit is kept, and an empty table has no sparse column.
    """
    seen = wide_counts(df).first()
    rows = seen["n_rows"]
    sparse = [c for i, c in enumerate(df.columns) if seen[f"c{i}"] < rows * (1 - max_null)]
    return sparse, rows


def drop_sparse(df: DataFrame, max_null: float = 0.5) -> DataFrame:
    return df.drop(*sparse_columns(df, max_null)[0])


def drop_thin_rows(df: DataFrame, thresh: int = 5, subset=None) -> DataFrame:
    """Keep rows with at least ``thresh`` values that are neither NULL nor NaN."""
    return df.na.drop(thresh=thresh, subset=list(subset) if subset else None)


def with_reject_reason(df: DataFrame, types: dict[str, str], also: Column | None = None) -> DataFrame:
    """Convert text columns and name, per row, the columns whose text did not convert.

    A NULL input is not a failure. Rows without failures get a NULL reason. ``also``
    is a further reason, NULL for rows it does not concern.
    """
    failed = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()
    ]
    named = F.concat_ws(",", *failed, *([] if also is None else [also]))
    return df.withColumn("reject_reason", F.when(named != "", named)).withColumns(
        {c: F.col(c).try_cast(t) for c, t in types.items()}
    )


def split_valid(
    df: DataFrame, types: dict[str, str], also: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows that convert, rows that do not with ``reject_reason`` and their original text)."""
    checked = with_reject_reason(df.withColumn("_source", F.struct(*types)), types, also)
    good = checked.where(F.col("reject_reason").isNull()).drop("reject_reason", "_source")
    bad = checked.where(F.col("reject_reason").isNotNull()).withColumns(
        {c: F.col(f"_source.{c}") for c in types}
    )
    return good, bad.drop("_source")


def flag_valid(df: DataFrame, array: str = "features_array") -> DataFrame:
    """``is_valid``: the feature array exists and holds neither NULL nor NaN."""
    hole = F.exists(F.col(array), lambda x: x.isNull() | F.isnan(x))
    return df.withColumn("is_valid", F.when(F.col(array).isNotNull() & ~hole, True).otherwise(False))
