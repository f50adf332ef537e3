"""Metric registry (SE-01): named metric rows appended into one table.

The reference keeps per-process dicts of rounded numbers. Here a registry is
a DataFrame; ``register`` appends one named row (4 decimals) with
``unionByName(allowMissingColumns=True)``, so regression, classification
and clustering rows can share one table. ``store_metrics`` keeps such rows in
a stored registry that outlives the process.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...sources.publish import current_version, publish, read_published


def metric_row(name: str, metrics: DataFrame, digits: int = 4) -> DataFrame:
    cols = []
    for f in metrics.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return metrics.select(F.lit(name).alias("algorithm"), *cols)


def register(registry: DataFrame | None, name: str, metrics: DataFrame,
             digits: int = 4) -> DataFrame:
    row = metric_row(name, metrics, digits)
    return row if registry is None else registry.unionByName(row, allowMissingColumns=True)


def store_metrics(rows: DataFrame, dst: str, run: int, name: str = "algorithm") -> DataFrame:
    """Upsert metric rows into the registry published at ``dst`` and return it.

    A row is known by its ``name``, and that of the latest ``run`` stays, so a
    run that is repeated changes nothing but its own rows, and one that comes
    late does not undo a later one. Runs may have different columns. The new
    table replaces the old one in a single step (``sources.publish``); one
    writer at a time."""
    spark = rows.sparkSession
    new = rows.withColumns({"run": F.lit(run).cast("long"), "_new": F.lit(1)})
    if current_version(spark, dst) is not None:
        old = read_published(spark, dst).withColumn("_new", F.lit(0))
        new = old.unionByName(new, allowMissingColumns=True)
    latest = Window.partitionBy(name).orderBy(F.desc("run"), F.desc("_new"))
    one = new.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank", "_new")
    return publish(one, dst)
