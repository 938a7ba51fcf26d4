"""Least squares as SQL text: the normal equations solved on covariances."""

from __future__ import annotations


def fit_ctes(name: str, source: str, label: str, features) -> str:
    """CTEs ending in ``name``: one row with ``intercept`` and ``b_<feature>`` columns."""
    columns = [*features, label]
    moments = [f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in columns]
    moments += [
        f"covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c_{a}_{b}"
        for i, a in enumerate(columns)
        for b in columns[i:]
    ]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    steps = [f"SELECT {', '.join(moments)} FROM {source} WHERE {complete}"]
    for k, pivot in enumerate(features):
        rest = columns[k + 1 :]
        reduced = [
            f"c_{a}_{b} - c_{pivot}_{a} * c_{pivot}_{b} / c_{pivot}_{pivot} AS c_{a}_{b}"
            for i, a in enumerate(rest)
            for b in rest[i:]
        ]
        steps.append(f"SELECT * REPLACE ({', '.join(reduced)}) FROM {{prev}}")
    for k in reversed(range(len(features))):
        f = features[k]
        known = "".join(f" - c_{f}_{g} * b_{g}" for g in features[k + 1 :])
        steps.append(f"SELECT *, (c_{f}_{label}{known}) / c_{f}_{f} AS b_{f} FROM {{prev}}")
    shift = "".join(f" - b_{f} * m_{f}" for f in features)
    steps.append(f"SELECT *, m_{label}{shift} AS intercept FROM {{prev}}")
    names = [f"{name}_{i}" for i in range(len(steps) - 1)] + [name]
    return ", ".join(
        f"{own} AS ({text.format(prev=names[i - 1])})" for i, (own, text) in enumerate(zip(names, steps))
    )


def prediction(name: str, features) -> str:
    """Scalar expression for the fitted value; join ``name`` (one row) into FROM."""
    return f"{name}.intercept" + "".join(f" + {name}.b_{f} * {f}" for f in features)


def metrics(source: str, label: str, value: str) -> str:
    """SELECT giving n, rmse, r2, mae of ``value`` against ``label``."""
    gap = f"({label} - {value})"
    return (
        f"SELECT count({gap}) AS n, round(sqrt(avg({gap} * {gap})), 6) AS rmse, "
        f"round(1 - avg({gap} * {gap}) / var_pop(CASE WHEN {gap} IS NOT NULL THEN CAST({label} AS DOUBLE) END), 6) AS r2, "
        f"round(avg(abs({gap})), 6) AS mae FROM {source}"
    )
