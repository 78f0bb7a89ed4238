"""All queries of the core, and their SQL."""

from __future__ import annotations

from types import SimpleNamespace

from . import basics, feature_queries, metric_queries, normalize_queries, problems, problems_sql, reconcile_queries, store_queries

MODULES = (SimpleNamespace(QUERIES=problems.QUERIES, SQL=problems_sql.SQL), basics, metric_queries, normalize_queries, reconcile_queries, feature_queries, store_queries)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
