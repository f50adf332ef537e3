"""Connected components by alternating large-star and small-star.

Each round is two equi-joins and two partial aggregates over the edge list;
no neighbourhood is ever gathered into one task. The minima are written before
they are joined, so that the skew join can split the rows of a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
    return materialize(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), name)


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = materialize(down.groupBy("u").agg(F.min("v").alias("m")), name)
    rest = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges(u, v)`` of long ids, in any direction, repeats and loops
    allowed; returns ``(id, component)`` for every node that has an edge to
    another node, ``component`` being the smallest id reachable. Nulls are
    ignored; an empty table gives an empty table."""
    current = materialize(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
                          .where("u is not null and v is not null and u <> v").distinct(), name)
    state = None
    while True:
        row = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state or row[0] == 0:
            break
        state = tuple(row)
        current = materialize(_small_star(_large_star(current, name), name), name)
    nodes = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionAll(nodes.select(F.col("component").alias("id"), "component").distinct())
