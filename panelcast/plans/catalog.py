"""All registered queries and their DuckDB twins."""

from __future__ import annotations

from . import forecast_queries, io_queries, model_queries, panel_queries, profile_queries  # noqa: F401  (register on import)
from .registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
