"""Collects the queries that the modules of this package define."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
SQL: dict[str, str] = {}
_MODULES = ("tables", "values", "serving", "models", "streams")


def query(name: str, sql: str | None = None):
    def add(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"workload.{module}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
