"""Training, scoring and evaluation on one feature contract."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.functions.values import all_present, present
from stridecast.functions.vectors import assembler
from stridecast.schema import FeatureContract


def training_rows(df: DataFrame, contract: FeatureContract) -> DataFrame:
    """Only the contracted columns, and only rows where all of them are present."""
    contract.require(df.columns, with_label=True)
    used = [contract.label, *contract.features]
    return df.select(*[F.col(c).cast("double").alias(c) for c in used]).na.drop("any")


def _fit(estimator, df: DataFrame, contract: FeatureContract) -> PipelineModel:
    # "keep" lets the stored model pass incomplete rows through scoring; training
    # itself sees complete rows only.
    stages = [assembler(contract.features, on_invalid="keep"), estimator]
    return Pipeline(stages=stages).fit(training_rows(df, contract))


def train(df: DataFrame, contract: FeatureContract, **params) -> PipelineModel:
    """Linear regression by normal equations: one distributed aggregate over the rows."""
    settings = {"solver": "normal", **params}
    return _fit(LinearRegression(labelCol=contract.label, **settings), df, contract)


def train_forest(df: DataFrame, contract: FeatureContract, seed: int = 42, **params) -> PipelineModel:
    return _fit(RandomForestRegressor(labelCol=contract.label, seed=seed, **params), df, contract)


def contract_of(model, features=None, label: str | None = None) -> FeatureContract:
    """The contract a model was fitted on, read from the model itself.

    A bare regression model does not know its input names; give ``features``.
    """
    if isinstance(model, PipelineModel):
        inputs = next(s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler))
        return FeatureContract(label=model.stages[-1].getLabelCol(), features=tuple(inputs))
    if features is None:
        raise ValueError("this model carries no feature names; pass them")
    if model.numFeatures != len(features):
        raise ValueError(f"model expects {model.numFeatures} features, got {len(features)}")
    return FeatureContract(label=label or model.getLabelCol(), features=tuple(features))


def as_pipeline(model, features=None) -> PipelineModel:
    """Wrap a bare regression model so that it takes columns like a trained pipeline."""
    if isinstance(model, PipelineModel):
        return model
    contract = contract_of(model, features)
    return PipelineModel(stages=[assembler(contract.features, on_invalid="keep"), model])


def score(model, df: DataFrame, output: str = "prediction", features=None) -> DataFrame:
    """Add the prediction; NULL where a feature is missing. Checks columns before any job."""
    pipeline = as_pipeline(model, features)
    contract = contract_of(pipeline)
    contract.require(df.columns)
    complete = all_present(df, contract.features)
    return (
        pipeline.transform(df)
        .withColumn("prediction", F.when(complete, F.col("prediction")))
        .drop("features")
        .withColumnRenamed("prediction", output)
    )


def evaluate(df: DataFrame, label: str, prediction: str = "prediction", by=()) -> DataFrame:
    """n, rmse, r2 and mae (per ``by`` group) in one aggregate over rows holding both values."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    both = present(df, label) & present(df, prediction)
    sums = df.where(both).groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg((y - p) * (y - p)).alias("_mse"),
        F.var_pop(y).alias("_var"),
        F.avg(F.abs(y - p)).alias("mae"),
    )
    return sums.select(
        *by,
        "n",
        F.sqrt("_mse").alias("rmse"),
        (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"),
        "mae",
    )


@dataclass(frozen=True)
class ModelMetrics:
    n: int
    rmse: float
    r2: float
    mae: float


def metrics_of(df: DataFrame, label: str, prediction: str = "prediction") -> ModelMetrics:
    return ModelMetrics(**evaluate(df, label, prediction).first().asDict())


def training_metrics(model: PipelineModel) -> ModelMetrics | None:
    """Metrics on the rows a linear model was just fitted on, without another pass.

    Fitting already computed them; None for models that keep no such summary.
    """
    fitted = model.stages[-1]
    if not isinstance(fitted, LinearRegressionModel) or not fitted.hasSummary:
        return None
    seen = fitted.summary
    return ModelMetrics(
        seen.numInstances, seen.rootMeanSquaredError, seen.r2, seen.meanAbsoluteError
    )


def metrics_row(df: DataFrame, label: str, model_name: str, prediction: str = "prediction") -> DataFrame:
    return evaluate(df, label, prediction).select(F.lit(model_name).alias("model"), "*")


def cutoff_date(df: DataFrame, share: float = 0.8) -> dt.date:
    """Date lying ``share`` of the way from the first to the last date. One job."""
    lo, hi = df.agg(F.min("date"), F.max("date")).first()
    if lo is None:
        raise ValueError("no dates to split by")
    return lo + dt.timedelta(days=int((hi - lo).days * share))


def split(df: DataFrame, cutoff) -> tuple[DataFrame, DataFrame]:
    """(rows before the cutoff date, rows on or after it)."""
    edge = F.lit(cutoff).cast("date")
    return df.where(F.col("date") < edge), df.where(F.col("date") >= edge)


def split_by_hash(df: DataFrame, keys, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash: the same rows on every run and any partitioning."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(100))
    return df.where(slot >= test_percent), df.where(slot < test_percent)


def compare_models(models: dict, df: DataFrame, label: str) -> DataFrame:
    """One metrics row per named model; all models score the same single pass."""
    names = list(models)
    scored = df
    for i, name in enumerate(names):
        scored = score(models[name], scored, output=f"_p{i}")
    y = F.col(label).cast("double")
    sums = []
    for i in range(len(names)):
        p = F.col(f"_p{i}")
        both = present(df, label) & p.isNotNull()
        gap = F.when(both, y - p)
        sums += [
            F.count(gap).alias(f"n{i}"),
            F.avg(gap * gap).alias(f"mse{i}"),
            F.var_pop(F.when(both, y)).alias(f"var{i}"),
            F.avg(F.abs(gap)).alias(f"mae{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(f"n{i}").alias("n"),
            F.sqrt(f"mse{i}").alias("rmse"),
            (1 - F.try_divide(F.col(f"mse{i}"), F.col(f"var{i}"))).alias("r2"),
            F.col(f"mae{i}").alias("mae"),
        )
        for i, name in enumerate(names)
    ]
    return scored.agg(*sums).select(F.inline(F.array(*rows)))
