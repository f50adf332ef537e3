"""Sinks and jobs (IO-02, IO-03, IO-04, IO-09)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .publish import publish

MANIFEST_SCHEMA = T.StructType([
    T.StructField("filepaths", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("card type", T.StringType()),
    T.StructField("data set", T.StringType()),
])


def write_result(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> str:
    """IO-02: parquet sink. Column names with spaces are kept as they are."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def run_report(spark: SparkSession, report: Callable[[DataFrame], DataFrame],
               src: str, dst: str) -> DataFrame:
    """IO-03: the daily job without its scheduler: read the games, compute
    the report, publish it as the current version of ``dst`` and return it
    read back. Running it twice gives the same table; readers
    (``read_published``) never see it missing or half written, and a run that
    fails leaves the version before."""
    return publish(report(spark.read.parquet(src)), dst)


def read_manifest(spark: SparkSession, path: str,
                  schema: T.StructType = MANIFEST_SCHEMA) -> DataFrame:
    """IO-04: CSV with a header and a declared schema (no inference pass)."""
    return spark.read.csv(path, header=True, schema=schema)


def profile(df: DataFrame, name: str = "") -> DataFrame:
    """IO-09: one row: table name, column count, row count, schema text
    (one aggregate job; ``show`` / ``printSchema`` are for the console)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), F.lit(len(df.columns)).alias("n_columns"), "n_rows",
        F.lit(df.schema.simpleString()).alias("schema"))
