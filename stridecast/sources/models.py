"""Saved models and their registry."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from stridecast.operators.regression import ModelMetrics
from stridecast.schema import FeatureContract

_LOADERS = {
    "PipelineModel": PipelineModel,
    "LinearRegressionModel": LinearRegressionModel,
    "RandomForestRegressionModel": RandomForestRegressionModel,
}

REGISTRY_SCHEMA = (
    "model string, path string, label string, features array<string>, dropped array<string>, "
    "n long, rmse double, r2 double, mae double"
)


def save_model(model, path: str, overwrite: bool = True) -> None:
    writer = model.write()
    if overwrite:
        writer = writer.overwrite()
    writer.save(path)


def load_model(spark: SparkSession, path: str):
    """A saved pipeline or bare regression model; a missing model is an error."""
    try:
        kind = spark.read.json(f"{path}/metadata").select("class").first()["class"]
    except AnalysisException as error:
        raise FileNotFoundError(f"no saved model at {path}") from error
    name = kind.rpartition(".")[2]
    if name not in _LOADERS:
        raise ValueError(f"{path} holds a {kind}, not a model this library scores with")
    return _LOADERS[name].load(path)


def register_model(
    spark: SparkSession,
    registry: str,
    name: str,
    path: str,
    contract: FeatureContract,
    metrics: ModelMetrics,
) -> None:
    """Append one row describing a saved model."""
    row = (
        name,
        path,
        contract.label,
        list(contract.features),
        list(contract.dropped),
        metrics.n,
        metrics.rmse,
        metrics.r2,
        metrics.mae,
    )
    entry = spark.createDataFrame([row], REGISTRY_SCHEMA)
    entry.withColumn("registered_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
        registry
    )


def registered_models(spark: SparkSession, registry: str) -> DataFrame:
    return spark.read.parquet(registry)


def load_newest(spark: SparkSession, registry: str, name: str):
    """The model of this name that was registered last; none is an error."""
    try:
        known = registered_models(spark, registry).where(F.col("model") == name)
        newest = known.orderBy(F.desc("registered_at"), F.desc("path")).select("path").first()
    except AnalysisException as error:
        raise FileNotFoundError(f"no registry at {registry}") from error
    if newest is None:
        raise FileNotFoundError(f"no model named {name} in {registry}")
    return load_model(spark, newest["path"])
