"""Parquet scans of the given tables and of written results (IO-01, IO-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the given tables. Projections and filters applied later
    reach the parquet reader (ReadSchema / PushedFilters)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """IO-01: scan a games dataset written as parquet (schema from the footer)."""
    return spark.read.parquet(path)


def load_result(spark: SparkSession, path: str) -> DataFrame:
    """IO-10: read back a report written by ``write_result``."""
    return spark.read.parquet(path)
