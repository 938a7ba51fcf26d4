"""Fit, evaluate, save and register a model from the mobility table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stridecast.functions.messages import short_metric_names
from stridecast.operators.cleaning import drop_thin_rows
from stridecast.operators.regression import (
    ModelMetrics,
    cutoff_date,
    metrics_of,
    score,
    split,
    train,
    train_forest,
    training_metrics,
)
from stridecast.schema import DATE_PARTS, DEFAULT_CONTRACT, FeatureContract
from stridecast.sources.files import read_mobility
from stridecast.sources.models import register_model, save_model

TRAINERS = {"LinearRegression": train, "RandomForest": train_forest}


@dataclass(frozen=True)
class TrainingResult:
    path: str
    contract: FeatureContract
    metrics: ModelMetrics


def prepare(df: DataFrame, thresh: int = 5) -> DataFrame:
    """Short metric names, and only rows with at least ``thresh`` present columns."""
    return short_metric_names(drop_thin_rows(df.drop(*DATE_PARTS), thresh))


def fit_and_save(
    table: DataFrame,
    models_root: str,
    kind: str = "LinearRegression",
    contract: FeatureContract = DEFAULT_CONTRACT,
    holdout_share: float | None = 0.2,
    allow_missing: bool = True,
    **params,
) -> TrainingResult:
    """Train on the earlier dates, evaluate on the later ones.

    ``holdout_share=None`` trains and evaluates on all rows. A contracted feature
    that ingest pruned is recorded as dropped, or refused with
    ``allow_missing=False``. Each training saves to a folder of its own; the
    registry names it once it is complete.
    """
    rows = prepare(table)
    if allow_missing:
        contract = contract.without([f for f in contract.features if f not in rows.columns])
    contract.require(rows.columns, with_label=True)
    fitted_on, judged_on = rows, rows
    if holdout_share is not None:
        fitted_on, judged_on = split(rows, cutoff_date(rows, 1 - holdout_share))
    model = TRAINERS[kind](fitted_on, contract, **params)
    metrics = training_metrics(model) if holdout_share is None else None
    if metrics is None:
        metrics = metrics_of(score(model, judged_on), contract.label)
    path = f"{models_root}/{kind}/{uuid.uuid4().hex}"
    save_model(model, path, overwrite=False)
    register_model(table.sparkSession, f"{models_root}/registry", kind, path, contract, metrics)
    return TrainingResult(path, contract, metrics)


def train_from_table(spark: SparkSession, root: str, models_root: str, **options) -> TrainingResult:
    return fit_and_save(read_mobility(spark, root, with_partitions=False), models_root, **options)
