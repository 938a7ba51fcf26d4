"""Fitting, scoring and evaluating on one contract."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridecast.functions import vectors
from stridecast.operators import regression
from stridecast.plans.ingest import ingest_table
from stridecast.plans.training import train_from_table
from stridecast.schema import DEFAULT_CONTRACT, FeatureContract
from stridecast.sources import models
from tests.test_files import mobility

PAIR = FeatureContract("y", ("a", "b"))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=400), rng.normal(size=400)
    y = 3 * a - 2 * b + 1 + rng.normal(scale=0.1, size=400)
    start = dt.date(2021, 1, 1)
    data = [(int(i), start + dt.timedelta(days=int(i % 100)), float(a[i]), float(b[i]), float(y[i])) for i in range(400)]
    return spark.createDataFrame(data, "id int, date date, a double, b double, y double")


@pytest.fixture(scope="module")
def model(rows):
    return regression.train(rows, PAIR)


def test_coefficients_match_least_squares(rows, model):
    data = np.array(rows.select("a", "b", "y").collect())
    design = np.column_stack([data[:, :2], np.ones(len(data))])
    expected = np.linalg.lstsq(design, data[:, 2], rcond=None)[0]
    fitted = model.stages[-1]
    assert np.allclose([*fitted.coefficients, fitted.intercept], expected)


def test_evaluate_matches_the_evaluator(rows, model):
    scored = regression.score(model, rows)
    found = regression.metrics_of(scored, "y")
    for name in ("rmse", "r2", "mae"):
        expected = RegressionEvaluator(labelCol="y", metricName=name).evaluate(scored)
        assert getattr(found, name) == pytest.approx(expected)
    assert found.n == 400


def test_metrics_of_the_fit_need_no_second_pass(rows, model):
    kept, again = regression.training_metrics(model), regression.metrics_of(regression.score(model, rows), "y")
    assert (kept.n, kept.rmse, kept.r2, kept.mae) == pytest.approx((again.n, again.rmse, again.r2, again.mae))
    forest = regression.train_forest(rows, PAIR, numTrees=3)
    assert regression.training_metrics(forest) is None


def test_constant_label_has_no_r2(spark):
    scored = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "y double, prediction double")
    row = regression.evaluate(scored, "y").first()
    assert row["r2"] is None and row["rmse"] == 0.5


def test_rows_with_gaps_are_not_trained_on_and_score_null(spark, rows, model):
    gap = spark.createDataFrame([(-1, None, None, 1.0, 9.0), (-2, None, float("nan"), 1.0, 9.0)], rows.schema)
    refit = regression.train(rows.unionByName(gap), PAIR)
    assert np.allclose(refit.stages[-1].coefficients, model.stages[-1].coefficients)
    assert [r["prediction"] for r in regression.score(model, gap).collect()] == [None, None]


def test_missing_feature_fails_before_running(rows, model):
    with pytest.raises(ValueError, match="lacks contracted columns"):
        regression.score(model, rows.drop("b"))
    with pytest.raises(ValueError, match="lacks contracted columns"):
        regression.train(rows.drop("y"), PAIR)


def test_label_cannot_be_a_feature():
    with pytest.raises(ValueError, match="label"):
        FeatureContract("a", ("a", "b"))


def test_bare_model_is_wrapped_and_checked(spark, rows, folder):
    bare = LinearRegression(labelCol="y").fit(vectors.assemble(rows, PAIR.features))
    models.save_model(bare, folder)
    loaded = models.load_model(spark, folder)
    scored = regression.score(loaded, rows, features=PAIR.features)
    assert regression.metrics_of(scored, "y").r2 > 0.99
    with pytest.raises(ValueError, match="expects 2 features"):
        regression.score(loaded, rows, features=("a", "b", "id"))
    with pytest.raises(ValueError, match="no feature names"):
        regression.score(loaded, rows)


def test_saving_twice_and_loading_nothing(spark, model, folder):
    models.save_model(model, folder)
    models.save_model(model, folder)
    with pytest.raises(Exception, match="already exists"):
        models.save_model(model, folder, overwrite=False)
    assert regression.contract_of(models.load_model(spark, folder)) == PAIR
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, folder + "-absent")


def test_each_training_keeps_its_model_and_the_newest_is_loaded(spark, folder):
    ingest_table(mobility(spark), folder + "-table", max_null=0.9)
    paths = [train_from_table(spark, folder + "-table", folder, contract=FeatureContract("residential", (f,))).path for f in ("retail", "grocery")]
    assert len(set(paths)) == 2
    kept = [regression.contract_of(models.load_model(spark, p)).features for p in paths]
    assert kept == [("retail",), ("grocery",)]
    newest = models.load_newest(spark, folder + "/registry", "LinearRegression")
    assert regression.contract_of(newest).features == ("grocery",)
    for registry, name in ((folder + "/registry", "RandomForest"), (folder + "/absent", "LinearRegression")):
        with pytest.raises(FileNotFoundError):
            models.load_newest(spark, registry, name)


def test_assembler_modes(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 2.0)], "a double, b double")
    assert vectors.assemble(rows, ("a", "b"), "skip").count() == 1
    kept = vectors.assemble(rows, ("a", "b"), "keep").select(vectors.features_array().alias("v")).collect()
    assert all(np.isnan(r["v"][0]) for r in kept[1:])
    with pytest.raises(Exception):
        vectors.assemble(rows, ("a", "b")).collect()


def test_vectors_as_arrays_in_sql_text(spark):
    rows = [(0, Vectors.dense(1.0, 2.0)), (1, Vectors.sparse(3, [1], [5.0])), (2, None)]
    df = vectors.with_arrays(spark.createDataFrame(rows, T.StructType([T.StructField("id", T.LongType()), T.StructField("v", VectorUDT())])))
    found = spark.sql("SELECT id, v_array FROM {rows} ORDER BY id", rows=df)
    assert [r["v_array"] for r in found.collect()] == [[1.0, 2.0], [0.0, 5.0, 0.0], None]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_hash_split_is_stable(rows):
    train_a, test_a = regression.split_by_hash(rows, ["id"])
    _, test_b = regression.split_by_hash(rows.repartition(7).orderBy(F.desc("id")), ["id"])
    ids = {r["id"] for r in test_a.collect()}
    assert ids == {r["id"] for r in test_b.collect()}
    assert train_a.count() + len(ids) == 400 and 40 < len(ids) < 120


def test_date_split(rows):
    cutoff = regression.cutoff_date(rows, 0.8)
    early, late = regression.split(rows, cutoff)
    assert cutoff == dt.date(2021, 1, 1) + dt.timedelta(days=79)
    assert early.count() + late.count() == 400
    assert early.agg(F.max("date")).first()[0] < cutoff <= late.agg(F.min("date")).first()[0]


def test_compare_models(rows, model):
    single = regression.train(rows, FeatureContract("y", ("a",)))
    found = {r["model"]: r for r in regression.compare_models({"pair": model, "single": single}, rows, "y").collect()}
    alone = regression.metrics_of(regression.score(single, rows), "y")
    assert found["single"]["rmse"] == pytest.approx(alone.rmse)
    assert found["pair"]["rmse"] < found["single"]["rmse"]


@pytest.mark.parametrize("holdout", [None, 0.25])
def test_training_plan_registers_dropped_features(spark, folder, holdout):
    source = mobility(spark, 80).withColumn(
        "retail_and_recreation_percent_change_from_baseline", (F.rand(1) * 40).cast("int")
    )
    ingest_table(source, folder + "/table", partition_by=("année", "mois"))
    result = train_from_table(
        spark, folder + "/table", folder + "/models", contract=DEFAULT_CONTRACT, holdout_share=holdout
    )
    assert result.contract.dropped == ("parks",)
    entry = models.registered_models(spark, folder + "/models/registry").first()
    assert entry["features"] == ["grocery", "transit", "workplaces", "residential"]
    assert entry["dropped"] == ["parks"] and entry["rmse"] == pytest.approx(result.metrics.rmse)
    with pytest.raises(ValueError, match="parks"):
        train_from_table(spark, folder + "/table", folder + "/models", allow_missing=False)


def test_forest_is_repeatable(rows):
    first, second = (regression.train_forest(rows, PAIR, numTrees=4) for _ in range(2))
    a = regression.score(first, rows).orderBy("id").collect()
    assert a == regression.score(second, rows).orderBy("id").collect()
