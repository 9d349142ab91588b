"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.views import ShopViews
from .oracle import with_views

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None, whole_sql: bool = False):
    """Register ``fn(views) -> DataFrame`` under ``name`` with its oracle.

    ``whole_sql`` says that the oracle defines the shop views itself.
    """
    def deco(fn: Callable[[ShopViews], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ShopViews(spark, sf_dir))
        build.__name__ = name
        build.__doc__ = fn.__doc__
        REGISTRY[name] = (build, with_views(sql) if sql and not whole_sql else sql)
        return fn
    return deco


def all_queries() -> dict[str, Builder]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load() -> None:
    from . import quality_queries, queries, request_queries, stored_queries  # noqa: F401  (register on import)
