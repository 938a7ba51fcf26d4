"""Training, evaluation and model storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridecast.functions import vectors
from stridecast.functions.messages import long_metric_names
from stridecast.operators import regression
from stridecast.plans.training import fit_and_save
from stridecast.schema import FeatureContract
from stridecast.scratch import new_folder
from stridecast.sources import models
from workload.least_squares import fit_ctes, metrics, prediction
from workload.registry import query
from workload.views import mobility, sql

TRIO = FeatureContract("retail", ("grocery", "transit", "workplaces"))
PAIR = FeatureContract("retail", ("grocery", "workplaces"))
SINGLE = FeatureContract("retail", ("grocery",))

FIT_TRIO = fit_ctes("trio", "mobility", TRIO.label, TRIO.features)
TRIO_VALUE = prediction("trio", TRIO.features)


def scored_cte(name: str, contract: FeatureContract, source: str = "mobility") -> str:
    """CTE ``<name>_scored`` with the fitted value as ``p``."""
    return f"{name}_scored AS (SELECT *, {prediction(name, contract.features)} AS p FROM {source}, {name})"


_TRIO_SCORED = f"{FIT_TRIO}, {scored_cte('trio', TRIO)}"
_TRIO_METRICS = metrics("trio_scored", "retail", "p")


def rounded(df, places: int = 6):
    names = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, places) + 0.0 for c in names})


def trained(spark, sf_dir):
    return regression.train(mobility(spark, sf_dir), TRIO)


def _trio_scored(spark, sf_dir):
    return regression.score(trained(spark, sf_dir), mobility(spark, sf_dir))


@query(
    "m1_assemble",
    sql(
        "SELECT place_id, date, CAST(grocery AS DOUBLE) AS f0, CAST(transit AS DOUBLE) AS f1, "
        "CAST(workplaces AS DOUBLE) AS f2 FROM mobility WHERE transit IS NOT NULL"
    ),
)
def m1(spark, sf_dir):
    rows = vectors.assemble(mobility(spark, sf_dir), TRIO.features, on_invalid="skip")
    array = vectors.features_array()
    return rows.select("place_id", "date", *[array[i].alias(f"f{i}") for i in range(3)])


@query(
    "m2_linear_regression",
    sql(
        "SELECT 'intercept' AS term, round(intercept, 6) AS coefficient FROM trio UNION ALL "
        + " UNION ALL ".join(f"SELECT '{f}', round(b_{f}, 6) FROM trio" for f in TRIO.features),
        FIT_TRIO,
    ),
)
def m2(spark, sf_dir):
    fitted = trained(spark, sf_dir).stages[-1]
    terms = [("intercept", float(fitted.intercept))]
    terms += [(f, float(b)) for f, b in zip(TRIO.features, fitted.coefficients)]
    return rounded(spark.createDataFrame(terms, "term string, coefficient double"))


@query("m3_random_forest")
def m3(spark, sf_dir):
    rows = mobility(spark, sf_dir)
    forest = regression.train_forest(rows, TRIO, seed=42)
    return regression.metrics_row(regression.score(forest, rows), "retail", "RandomForest")


def _one_split(source: str, label: str, features) -> str:
    """CTE ``split``: the split with the least squared error among the midpoints of each feature's values, and both means."""
    complete = " AND ".join(f"{c} IS NOT NULL" for c in (label, *features))
    values = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, CAST({label} AS DOUBLE) AS y FROM {source} WHERE {complete}" for f in features
    )
    return (
        f"points AS (SELECT feature, x, count(*) AS n, sum(y) AS s FROM ({values}) GROUP BY ALL), "
        "steps AS (SELECT feature, (x + lead(x) OVER w) / 2 AS threshold, sum(n) OVER w AS n_low, sum(s) OVER w AS s_low, "
        "sum(n) OVER (PARTITION BY feature) AS n_all, sum(s) OVER (PARTITION BY feature) AS s_all FROM points WINDOW w AS (PARTITION BY feature ORDER BY x)), "
        "split AS (SELECT feature, threshold, s_low / n_low AS low, (s_all - s_low) / (n_all - n_low) AS high FROM steps "
        "WHERE threshold IS NOT NULL ORDER BY s_low * s_low / n_low + (s_all - s_low) * (s_all - s_low) / (n_all - n_low) DESC LIMIT 1)"
    )


@query(
    "m3_forest_of_one_split",
    sql(
        "SELECT place_id, date, retail, round(CASE WHEN "
        + " OR ".join(f"feature = '{f}' AND {f} <= threshold" for f in TRIO.features)
        + " THEN low ELSE high END, 4) + 0.0 AS prediction FROM mobility, split WHERE "
        + " AND ".join(f"{f} IS NOT NULL" for f in TRIO.features),
        _one_split("mobility", TRIO.label, TRIO.features),
    ),
)
def m3_one_split(spark, sf_dir):
    """A forest of one tree with one split over all rows and features: what SQL can fit too."""
    rows = mobility(spark, sf_dir)
    plain = {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "maxBins": 256}
    scored = regression.score(regression.train_forest(rows, TRIO, **plain), rows)
    return rounded(scored.where("prediction IS NOT NULL").select("place_id", "date", "retail", "prediction"), 4)


@query(
    "m4_score",
    sql(
        "SELECT place_id, date, retail, round(p, 4) + 0.0 AS prediction FROM trio_scored",
        _TRIO_SCORED,
    ),
)
def m4(spark, sf_dir):
    scored = _trio_scored(spark, sf_dir).select("place_id", "date", "retail", "prediction")
    return rounded(scored, 4)


def _metric_query(name: str, column: str):
    @query(name, sql(f"SELECT {column} FROM ({_TRIO_METRICS})", _TRIO_SCORED))
    def run(spark, sf_dir):
        return rounded(regression.evaluate(_trio_scored(spark, sf_dir), "retail")).select(column)

    return run


m5 = _metric_query("m5_rmse", "rmse")
m6 = _metric_query("m6_r2", "r2")
m7 = _metric_query("m7_mae", "mae")


@query(
    "k6_model_metrics",
    sql(f"SELECT 'LinearRegression' AS model, * FROM ({_TRIO_METRICS})", _TRIO_SCORED),
)
def k6(spark, sf_dir):
    return rounded(regression.metrics_row(_trio_scored(spark, sf_dir), "retail", "LinearRegression"))


_CUTOFF = (
    "cutoff AS (SELECT min(date) + CAST(floor(date_diff('day', min(date), max(date)) * 0.8) AS INTEGER) AS edge FROM mobility), "
    "early AS (SELECT mobility.* FROM mobility, cutoff WHERE date < edge), "
    "late AS (SELECT mobility.* FROM mobility, cutoff WHERE date >= edge)"
)


@query(
    "m8_holdout",
    sql(
        metrics("trio_scored", "retail", "p"),
        f"{_CUTOFF}, {fit_ctes('trio', 'early', TRIO.label, TRIO.features)}, {scored_cte('trio', TRIO, 'late')}",
    ),
)
def m8(spark, sf_dir):
    rows = mobility(spark, sf_dir)
    early, late = regression.split(rows, regression.cutoff_date(rows, 0.8))
    return rounded(regression.evaluate(regression.score(regression.train(early, TRIO), late), "retail"))


def _saved(spark, sf_dir):
    path = new_folder(spark, "model")
    models.save_model(trained(spark, sf_dir), path)
    return path


@query(
    "s8_load_model",
    sql("SELECT place_id, date, round(p, 4) + 0.0 AS prediction FROM trio_scored", _TRIO_SCORED),
)
def s8(spark, sf_dir):
    model = models.load_model(spark, _saved(spark, sf_dir))
    scored = regression.score(model, mobility(spark, sf_dir))
    return rounded(scored.select("place_id", "date", "prediction"), 4)


@query(
    "k4_save_model",
    sql(
        " UNION ALL ".join(
            f"SELECT 'retail' AS label, '{f}' AS feature, round(b_{f}, 6) AS coefficient FROM trio" for f in TRIO.features
        ),
        FIT_TRIO,
    ),
)
def k4(spark, sf_dir):
    """Saved twice to one path, then contract and coefficients read back from the saved model."""
    path = _saved(spark, sf_dir)
    models.save_model(trained(spark, sf_dir), path)
    model = models.load_model(spark, path)
    kept = regression.contract_of(model)
    rows = [(kept.label, f, float(b)) for f, b in zip(kept.features, model.stages[-1].coefficients, strict=True)]
    return rounded(spark.createDataFrame(rows, "label string, feature string, coefficient double"))


@query(
    "m9_load_newest",
    sql("SELECT 'late' AS fitted_on, round(intercept, 6) AS intercept, round(b_grocery, 6) AS grocery FROM solo",
        "late AS (SELECT * FROM mobility WHERE workplaces >= 5), " + fit_ctes("solo", "late", SINGLE.label, SINGLE.features)),
)
def m9_newest(spark, sf_dir):
    """Two trainings under one name keep a folder each; the later one is loaded."""
    root, rows = new_folder(spark, "models"), mobility(spark, sf_dir)
    late = rows.where("workplaces >= 5")
    for table in (rows, late):
        fit_and_save(long_metric_names(table), root, contract=SINGLE, holdout_share=None)
    fitted = models.load_newest(spark, f"{root}/registry", "LinearRegression").stages[-1]
    row = ("late", float(fitted.intercept), float(fitted.coefficients[0]))
    return rounded(spark.createDataFrame([row], "fitted_on string, intercept double, grocery double"))


@query(
    "m9_register_model",
    sql(
        "SELECT 'LinearRegression' AS model, 'retail' AS label, 'grocery,transit,workplaces' AS features, "
        f"'parks' AS dropped, n, rmse FROM ({_TRIO_METRICS})",
        _TRIO_SCORED,
    ),
)
def m9(spark, sf_dir):
    registry = new_folder(spark, "registry")
    path = _saved(spark, sf_dir)
    seen = regression.metrics_of(_trio_scored(spark, sf_dir), "retail")
    contract = FeatureContract(TRIO.label, ("grocery", "parks", "transit", "workplaces")).without(["parks"])
    models.register_model(spark, registry, "LinearRegression", path, contract, seen)
    return models.registered_models(spark, registry).select(
        "model",
        "label",
        F.concat_ws(",", "features").alias("features"),
        F.concat_ws(",", "dropped").alias("dropped"),
        "n",
        (F.round("rmse", 6) + 0.0).alias("rmse"),
    )


@query(
    "m10_compare_models",
    sql(
        f"SELECT 'pair' AS model, * FROM ({metrics('pair_scored', 'retail', 'p')}) UNION ALL "
        f"SELECT 'single', * FROM ({metrics('single_scored', 'retail', 'p')})",
        ", ".join(
            [
                fit_ctes("pair", "mobility", PAIR.label, PAIR.features),
                fit_ctes("single", "mobility", SINGLE.label, SINGLE.features),
                scored_cte("pair", PAIR),
                scored_cte("single", SINGLE),
            ]
        ),
    ),
)
def m10(spark, sf_dir):
    rows = mobility(spark, sf_dir)
    fitted = {"pair": regression.train(rows, PAIR), "single": regression.train(rows, SINGLE)}
    return rounded(regression.compare_models(fitted, rows, "retail"))
