"""Mobility-shaped views over the given tables, for Spark and as SQL text.

The expressions are written once and valid in both dialects. ``parks`` is mostly
NULL, so that ingest prunes it, and ``transit`` is NULL for a tenth of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stridecast.functions.messages import long_metric_names
from stridecast.schema import METRICS, SHORT_TO_LONG

MOBILITY = {
    "country_region_code": "l_returnflag",
    "country_region": "concat('country_', l_returnflag)",
    "place_id": "CAST(l_suppkey AS STRING)",
    "date": "CAST(l_shipdate AS DATE)",
    "retail": "CAST(2*l_quantity - round(l_discount*100) + (l_partkey % 7) - 40 AS INT)",
    "grocery": "CAST(l_quantity - 25 AS INT)",
    "parks": "CASE WHEN l_linenumber >= 3 THEN NULL ELSE CAST(l_suppkey % 61 - 30 AS INT) END",
    "transit": "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(round(l_tax*100) AS INT) END",
    "workplaces": "CAST(round(l_discount*100) AS INT)",
    "residential": "CAST(l_partkey % 41 - 20 AS INT)",
}

_WORKPLACES = MOBILITY["workplaces"]
PREDICTIONS = {
    "date": MOBILITY["date"],
    "country": MOBILITY["country_region"],
    "residential": "CAST(l_partkey % 41 - 20 AS DOUBLE)",
    "model": f"CASE WHEN {_WORKPLACES} % 2 = 0 THEN 'LinearRegression' ELSE 'RandomForest' END",
    "epoch_id": "l_linenumber",
    "created_at": "l_shipdate + l_linenumber * INTERVAL '1' HOUR",
    "is_valid": "l_partkey % 10 <> 0",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


PRELUDE = (
    f"WITH mobility AS (SELECT {_select(MOBILITY)} FROM lineitem), "
    f"predictions AS (SELECT {_select(PREDICTIONS)} FROM lineitem)"
)
LONG_COLUMNS = ", ".join(
    f"{c} AS {SHORT_TO_LONG[c]}" if c in SHORT_TO_LONG else c for c in MOBILITY
)


def sql(body: str, more: str = "") -> str:
    """``body`` with the views (and further CTEs ``more``) in front."""
    return f"{PRELUDE}{', ' + more if more else ''} {body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_mobility(lineitem: DataFrame, *extra: str) -> DataFrame:
    """Short metric names; also usable on a stream of ``lineitem``."""
    return lineitem.selectExpr(*[f"{expr} AS {name}" for name, expr in MOBILITY.items()], *extra)


def mobility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_mobility(table(spark, sf_dir, "lineitem"))


def mobility_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with the column names of the mobility files."""
    return long_metric_names(mobility(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.selectExpr(*[f"{expr} AS {name}" for name, expr in PREDICTIONS.items()])


def metric_doubles(columns=METRICS) -> str:
    return ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in columns)
