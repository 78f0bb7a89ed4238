"""The queries of this subpackage, and their SQL."""

from __future__ import annotations

from . import queries as _queries
from .sql import SQL


def queries() -> dict:
    return dict(_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
