"""Registry of named queries (``queries()``) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle``
    is DuckDB SQL over the same tables, or None for a rows-only check."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every catalog module so all queries are registered."""
    from . import (  # noqa: F401
        catalog, catalog_cards, catalog_metrics, catalog_mining, catalog_models,
        catalog_quantiles, catalog_streams,
    )
