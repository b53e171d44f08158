"""Key -> query and key -> oracle SQL for everything outside the training-data subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.adapters import Lake, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def exact_sum(x: str, over: str = "") -> str:
    """DuckDB SQL for the sum of doubles by their shortest decimal digits, rounded once, at the end."""
    return f"CAST(CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12))){over} AS VARCHAR) AS DOUBLE)"


def query(key: str, sql: str | None = None):
    """Register a function of a Lake under `key`; `sql` is its DuckDB oracle over the same views."""

    def add(f: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: f(Lake(spark, sf_dir))
        if sql:
            ORACLE_SQL[key] = oracle(sql)
        return f

    return add


def load_all() -> None:
    """Import every module of registered queries."""
    import importlib
    import pkgutil

    import tallyforge.plans as plans

    for module in sorted(m.name for m in pkgutil.iter_modules(plans.__path__)):
        importlib.import_module(f"tallyforge.plans.{module}")


load_all()
