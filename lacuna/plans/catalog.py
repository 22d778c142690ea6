"""Registry of the queries the driver runs: Spark callables and DuckDB oracle SQL.

Every query reads the driver tables under ``sf_dir`` (or panels Spark derives
from them) and runs over whole tables.  ``QUERIES[name] = (fn, sql_or_None)``;
``sql`` is None for operators that are not SQL-expressible (model fitting,
iterative methods); those are tested against NumPy on fixtures instead.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _load_all():
    # importing the modules registers their queries
    from . import q_clean, q_impute, q_missing, q_score, q_features, q_stats, q_models  # noqa: F401


def queries() -> dict[str, Callable]:
    _load_all()
    return {k: v[0] for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in QUERIES.items() if v[1]}
