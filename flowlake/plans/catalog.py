"""Registry of queries: name -> (callable, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_GROUPS = ["cleaning", "profiling", "exploring", "learning", "evaluating", "live", "runs"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for group in _GROUPS:
        import_module(f"flowlake.plans.{group}")
    return dict(_QUERIES), dict(_ORACLES)
