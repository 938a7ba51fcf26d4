"""Every operator as a query over the given tables, with its SQL counterpart."""

from workload.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
