"""Registry of the named queries run by the driver contract and the bench.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL over the same tables (or ``None`` when the operation
is not expressible in SQL, e.g. model fitting or streaming).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]          # SURVEY section 2 IDs this query exercises


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: tuple[str, ...] | str = (), sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (ops,) if isinstance(ops, str) else tuple(ops))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from . import (q_features, q_stats, q_windows, q_functions, q_sources,  # noqa: F401
                   q_quality, q_models, q_streaming, q_stores)
    return REGISTRY
