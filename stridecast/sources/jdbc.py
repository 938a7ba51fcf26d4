"""Relational tables over JDBC. Credentials come from the caller or the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Table names the scoring stream writes and the dashboard reads.
STAGING_TABLE = "predictions_staging"
PREDICTIONS_TABLE = "predictions"


@dataclass(frozen=True)
class JdbcConfig:
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    staging_table: str = STAGING_TABLE
    predictions_table: str = PREDICTIONS_TABLE
    probe_sql: str = "SELECT 1 AS test"
    fetch_size: int = 10_000
    batch_size: int = 10_000
    max_connections: int = 16
    extra: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls) -> "JdbcConfig":
        env = os.environ
        return cls(
            url=env["STRIDECAST_JDBC_URL"],
            driver=env["STRIDECAST_JDBC_DRIVER"],
            user=env.get("STRIDECAST_JDBC_USER"),
            password=env.get("STRIDECAST_JDBC_PASSWORD"),
        )


def base_options(cfg: JdbcConfig) -> dict[str, str]:
    given = {"url": cfg.url, "driver": cfg.driver, "user": cfg.user, "password": cfg.password}
    return {**cfg.extra, **{k: v for k, v in given.items() if v is not None}}


def table_options(cfg: JdbcConfig, table: str, split_by=None) -> dict[str, str]:
    """Read options. ``split_by`` is (column, lower, upper, parts): one connection per part."""
    options = {**base_options(cfg), "dbtable": table, "fetchsize": str(cfg.fetch_size)}
    if split_by:
        column, lower, upper, parts = split_by
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(min(parts, cfg.max_connections)),
        }
    return options


def staging_options(cfg: JdbcConfig) -> dict[str, str]:
    return {
        **base_options(cfg),
        "dbtable": cfg.staging_table,
        "batchsize": str(cfg.batch_size),
        "numPartitions": str(cfg.max_connections),
    }


def read_predictions(spark: SparkSession, cfg: JdbcConfig, split_by=None) -> DataFrame:
    """Predictions table; filters and column choices are pushed to the database."""
    options = table_options(cfg, cfg.predictions_table, split_by)
    return spark.read.format("jdbc").options(**options).load()


def read_jdbc_query(spark: SparkSession, cfg: JdbcConfig, sql: str) -> DataFrame:
    return spark.read.format("jdbc").options(**base_options(cfg), query=sql).load()


def connection_works(spark: SparkSession, cfg: JdbcConfig) -> bool:
    """True when the probe query returns a single 1."""
    row = read_jdbc_query(spark, cfg, cfg.probe_sql).first()
    return row is not None and row[0] == 1


def write_staging(df: DataFrame, cfg: JdbcConfig) -> None:
    df.write.format("jdbc").options(**staging_options(cfg)).mode("append").save()


def replace_predictions(df: DataFrame, cfg: JdbcConfig) -> None:
    """Refill the predictions table, keeping its definition and grants.

    ``df`` must not read that same table lazily: write it to a shared folder first.
    """
    options = staging_options(cfg) | {"dbtable": cfg.predictions_table, "truncate": "true"}
    df.write.format("jdbc").options(**options).mode("overwrite").save()
