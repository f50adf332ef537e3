"""A fitted decision tree as a table, and as an expression (ML-08).

The table has a row per node, by which trees are stored, compared and drawn.
The expression routes rows by it with nothing but comparisons and look-ups in
constant arrays, so scoring runs inside any query, without a model object,
Python or vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path


def tree_nodes(spark: SparkSession, model: DecisionTreeClassificationModel, features: list[str]) -> DataFrame:
    """One row per node of a fitted tree: ``node`` (the root is 1, the
    children of i are 2i, for values up to the threshold, and 2i + 1),
    ``depth``, ``feature`` and ``threshold`` (null at a leaf), ``impurity``,
    ``gain`` (null at a leaf), training ``rows``, ``counts`` of each class in
    the order of labels, and ``prediction``. A fitted tree has up to twice as
    many nodes as training rows: the saved model's table of nodes is read, and
    only the links between nodes (three numbers each) are walked here."""
    path = scratch_path(spark, "tree-model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    links = saved.select("id", "leftChild", "rightChild").toPandas().sort_values("id")  # a node comes before its children
    node, depth = np.ones(len(links), dtype=np.int64), np.zeros(len(links), dtype=np.int32)
    for i, left, right in links.to_numpy():
        if left >= 0:
            node[left], node[right] = 2 * node[i], 2 * node[i] + 1
            depth[left] = depth[right] = depth[i] + 1
    numbers = materialize(spark.createDataFrame(pd.DataFrame({"id": links["id"].to_numpy(), "node": node, "depth": depth}), "id int, node long, depth int"), "tree-numbers")
    inner = F.col("leftChild") >= 0
    name = F.get(F.array(*map(F.lit, features)), F.col("split.featureIndex"))
    table = saved.join(numbers, "id").select(
        "node", "depth", F.when(inner, name).alias("feature"), F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        "impurity", F.when(inner, F.col("gain")).alias("gain"), F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x).cast("long").alias("rows"),
        F.col("impurityStats").alias("counts"), "prediction")
    return materialize(table, "tree-nodes")


def _values(values, kind: str) -> Column:
    """A constant array, as one expression whatever its length."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _routed(nodes: DataFrame, *leaf) -> list[Column]:
    """What ``leaf(table)`` gives for the leaf that a row comes to. The tree is
    a few constant arrays that each row walks down, so the expression is no
    larger for a larger tree."""
    t = nodes.toPandas().sort_values("node", ignore_index=True)
    names = t["feature"].dropna().unique().tolist()
    inner = t["feature"].notna().to_numpy()
    place = {n: i for i, n in enumerate(t["node"].tolist())}
    left = [place[2 * n] if i else -1 for n, i in zip(t["node"].tolist(), inner)]
    right = [place[2 * n + 1] if i else -1 for n, i in zip(t["node"].tolist(), inner)]
    at = {n: i for i, n in enumerate(names)}
    place = F.lit(0)
    if names:
        reads = _values([at.get(f, -1) for f in t["feature"]], "int")
        ups = _values(t["threshold"].fillna(0.0).tolist(), "double")
        lefts, rights = _values(left, "int"), _values(right, "int")
        own = F.array(*[F.col(n).cast("double") for n in names])
        place = F.aggregate(F.sequence(F.lit(1), F.lit(int(t["depth"].max()))), F.lit(0), lambda i, _: F.when(F.get(lefts, i) < 0, i).when(
            F.get(own, F.get(reads, i)) <= F.get(ups, i), F.get(lefts, i)).otherwise(F.get(rights, i)))
    return [told(t, place) for told in leaf]


def leaf_of(nodes: DataFrame) -> Column:
    """The leaf that a row comes to, as an expression over the feature columns
    (a null value goes to the right, as it is not up to any threshold)."""
    return _routed(nodes, lambda t, i: F.get(_values(t["node"].tolist(), "bigint"), i))[0]


def score_of(nodes: DataFrame) -> tuple[Column, Column]:
    """Prediction and the share of each class at the row's leaf, as ``transform`` of the model gives them."""
    def share(t, i):
        shares = [[c / sum(counts) for c in counts] for counts in (list(map(float, x)) for x in t["counts"])]
        return F.slice(_values([x for s in shares for x in s], "double"), i * len(shares[0]) + 1, len(shares[0]))
    return tuple(_routed(nodes, lambda t, i: F.get(_values(t["prediction"].tolist(), "double"), i), share))


def weighted_precision(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: the mean of the classes' precisions, weighted by their rows."""
    cells = df.groupBy(F.col(label).alias("t"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    right = F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0))
    of_class = cells.groupBy(F.col("t").alias("c")).agg(F.sum("n").alias("support"), right.alias("hit"))
    told = cells.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("told"))
    return of_class.join(told, "c", "left").agg(
        (F.sum(F.col("support") * F.coalesce(F.try_divide(F.col("hit"), F.col("told")), F.lit(0.0))) / F.sum("support")).alias("precision"))
