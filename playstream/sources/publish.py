"""Published tables (IO-03): each run writes a new version, and one atomic
rename makes it the current one.

A folder holds ``versions/<name>`` and the file ``CURRENT``, which names the
version that readers get. A run that fails leaves its half-written version
unnamed, so readers go on with the old one; a reader that has begun keeps its
version until ``keep`` newer ones are there. One writer at a time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def _files(spark: SparkSession, folder: str):
    """The folder's file system and a maker of its paths."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def current_version(spark: SparkSession, dst: str) -> str | None:
    """The version that readers get, if one is published."""
    fs, path = _files(spark, dst)
    if not fs.exists(path(f"{dst}/{POINTER}")):
        return None
    return spark.read.text(f"{dst}/{POINTER}").first()[0]


def versions(spark: SparkSession, dst: str) -> list[str]:
    """All versions that are kept, complete or not, the oldest first."""
    fs, path = _files(spark, dst)
    if not fs.exists(path(f"{dst}/versions")):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path(f"{dst}/versions")))


def read_published(spark: SparkSession, dst: str) -> DataFrame:
    """The current version; an error if nothing was published yet."""
    version = current_version(spark, dst)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {dst}")
    return spark.read.parquet(f"{dst}/versions/{version}")


def _point(spark: SparkSession, dst: str, version: str) -> None:
    """Name the current version: a file written aside, then renamed over the
    old one in a single step."""
    fs, path = _files(spark, dst)
    aside, pointer = path(f"{dst}/.{POINTER}-{version}"), path(f"{dst}/{POINTER}")
    out = fs.create(aside, True)
    out.write(bytearray(version.encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(option, 1)
    how[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(pointer).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(pointer), how)


def publish(df: DataFrame, dst: str, keep: int = 2, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a new version, make it current, delete all but the
    newest ``keep`` versions, and return it read back. ``df`` may read the
    current version."""
    spark = df.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{dst}/versions/{version}")
    _point(spark, dst, version)
    fs, path = _files(spark, dst)
    for old in versions(spark, dst)[:-keep]:
        fs.delete(path(f"{dst}/versions/{old}"), True)
    return read_published(spark, dst)
