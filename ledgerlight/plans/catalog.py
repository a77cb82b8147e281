"""Query registry: every operator as a query over the driver tables, with its oracle.

Each entry pairs a Spark plan ``(spark, sf_dir) -> DataFrame`` with an
independent DuckDB SQL text (same column names) written in a *different
shape* where possible: range joins instead of window frames, classic
gaps-and-islands instead of bounded frames, direct joins instead of JSON round
trips. Queries without an SQL form (streams, run counters) register ``None``.

All queries read whole tables; no id subsets, samples or row caps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str            # inventory ids from the survey


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, sql: str | None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def load_all() -> dict[str, Query]:
    """Import the modules that register queries."""
    from . import queries_alerts, queries_journal, queries_decode, queries_logs, queries_stream  # noqa: F401
    return REGISTRY
