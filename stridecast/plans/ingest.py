"""Delimited files to pruned, date-partitioned Parquet."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stridecast.functions.times import with_date_parts
from stridecast.operators.cleaning import sparse_columns, split_valid
from stridecast.schema import CORRUPT_COLUMN, DATE_PARTS, MOBILITY_SCHEMA, MONTH_PARTS, PLACE_COLUMNS
from stridecast.sources.files import read_mobility_text, write_mobility

CONVERTED = {f.name: f.dataType.simpleString() for f in MOBILITY_SCHEMA if f.dataType.simpleString() != "string"}


@dataclass(frozen=True)
class IngestResult:
    n_rows: int
    n_columns: int
    dropped: tuple[str, ...]
    root: str
    n_rejected: int = 0


def ingest_table(df: DataFrame, root: str, max_null: float = 0.5, partition_by=MONTH_PARTS) -> IngestResult:
    """Two passes over the source: one aggregate for row and null counts, one write.

    Month directories keep files large; ``partition_by=DATE_PARTS`` makes one for each day.
    """
    dropped, n_rows = sparse_columns(df, max_null)
    if "date" in dropped:
        raise ValueError("the date column is too sparse to partition by")
    shaped = with_date_parts(df.drop(*dropped))
    shaped = shaped.drop(*[p for p in DATE_PARTS if p not in partition_by])
    write_mobility(shaped, root, partition_by, [c for c in PLACE_COLUMNS if c not in dropped])
    return IngestResult(n_rows, len(shaped.columns), tuple(dropped), root)


def ingest_csv(
    spark: SparkSession, path: str, root: str, strict: bool = True, rejects: str | None = None, **options
) -> IngestResult:
    """Load the rows whose cells all convert.

    The others, and rows with too many or too few cells, are counted in the pass
    that counts nulls. With a folder in ``rejects`` they are written there as they
    were read, with the reason.
    """
    seen = Observation()
    text = read_mobility_text(spark, path, strict).observe(seen, F.count(F.lit(1)).alias("n_read"))
    torn = F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("number of cells"))
    good, bad = split_valid(text, CONVERTED, torn)
    result = ingest_table(good.drop(CORRUPT_COLUMN), root, **options)
    n_rejected = seen.get["n_read"] - result.n_rows
    if rejects and n_rejected:
        bad.write.mode("overwrite").parquet(rejects)
    return replace(result, n_rejected=n_rejected)
