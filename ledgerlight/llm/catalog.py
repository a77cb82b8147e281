"""The ``opN_`` queries and their DuckDB oracles, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from .common import ship_package

Build = Callable[[SparkSession, str], DataFrame]
CORPUS: dict[str, tuple[Build, str | None]] = {}


def corpus_query(name: str, sql: str | None = None):
    def deco(fn: Build) -> Build:
        @wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        CORPUS[name] = (build, sql)
        return build
    return deco


def load_corpus() -> dict[str, tuple[Build, str | None]]:
    from . import queries  # noqa: F401

    return CORPUS
