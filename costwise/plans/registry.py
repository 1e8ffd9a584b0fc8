"""Query registry: each entry is a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the job is expressible in SQL, an independent DuckDB oracle over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, build, sql)
        return fn

    return deco
