"""All registered queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "asof_latest_bar"
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with SQL for the same rows if there is any."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _queries


def oracle_sql() -> dict[str, str]:
    return _sql


def load() -> None:
    """Imports the modules that register queries."""
    from . import curate, evaluation, inference, payloads, pit, portfolio, research, risk, rules, statistics, windows  # noqa: F401
