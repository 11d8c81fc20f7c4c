"""All queries of the engine by name, each with the DuckDB SQL of the same rows where SQL can say it."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``oracle`` is the DuckDB text for the same rows."""

    def put(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries are named {name}")
        _QUERIES[name] = f
        if oracle is not None:
            _ORACLES[name] = oracle
        return f

    return put


def _load() -> None:
    from cellweave import plans

    for m in pkgutil.iter_modules(plans.__path__):
        importlib.import_module(f"{plans.__name__}.{m.name}")


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLES
