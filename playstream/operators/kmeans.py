"""k-means from many starts at once (ML-09).

All starts share each pass over the rows: a task assigns its rows to the
centroids of every start by one matrix of distances and returns one row per
(start, cluster), so ten starts cost one scan a round and a few hundred rows in
the exchange, not ten fits. Starts that have settled drop out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Distances that a task holds at once.
CELLS = 1 << 20


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, dimension by dimension in order."""
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        out += (x[:, j, None] - centres[None, :, j]) ** 2
    return out


def _assigned(shared):
    """Per start and cluster: weight, weighted sum of vectors, and cost."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = shared.value  # start -> centroids
        n, sums, cost = ({s: np.zeros(shape) for s, shape in ((s, f(c)) for s, c in starts.items())}
                         for f in (lambda c: len(c), lambda c: c.shape, lambda c: len(c)))
        for pdf in batches:
            if not len(pdf):
                continue
            x, w = np.stack(pdf["x"].to_numpy()), pdf["w"].to_numpy(np.float64)
            step = max(1, CELLS // max(len(c) for c in starts.values()))
            for i in range(0, len(x), step):
                part, weight = x[i:i + step], w[i:i + step]
                for s, centres in starts.items():
                    sq = _squared(part, centres)
                    at = sq.argmin(axis=1)  # the first of equally near ones
                    n[s] += np.bincount(at, weight, len(centres))
                    cost[s] += np.bincount(at, weight * sq[np.arange(len(part)), at], len(centres))
                    for j in range(part.shape[1]):
                        sums[s][:, j] += np.bincount(at, weight * part[:, j], len(centres))
        yield pd.DataFrame([(s, k, n[s][k], sums[s][k], cost[s][k]) for s in starts for k in range(len(starts[s]))],
                           columns=["start", "cluster", "n", "total", "cost"])
    return run


def first_centroids(points: DataFrame, k: int, starts: int, seed: int) -> DataFrame:
    """``start, cluster, x``: for each start the ``k`` distinct points that
    come first by a hash of their components, the seed and the start. One
    pass; each task hands on ``k`` points a start."""
    text = F.array_join(F.transform("x", lambda v: F.format_string("%.6f", v)), ",")
    hashed = points.select("x", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))).alias("start")).withColumn(
        "h", F.md5(F.concat_ws(":", F.lit(seed), "start", text).cast("binary")))
    order = Window.partitionBy("start").orderBy("h", "x")
    return hashed.withColumn("cluster", F.row_number().over(order) - 1).where(F.col("cluster") < k).select("start", "cluster", "x")


def multi_start_kmeans(df: DataFrame, vec_col: str, k: int, starts: int = 10, seed: int = 1,
                       max_iter: int = 100, tol: float = 0.2) -> DataFrame:
    """Lloyd's iteration from ``starts`` first choices of ``k`` distinct
    vectors: ``start, cluster, centroid, n, cost, kept``, where ``n`` and
    ``cost`` (squared distances) are those of the cluster's rows and ``kept``
    marks the start of least total cost, the first of equal ones. A start ends
    when no centroid moves by more than ``tol`` or after ``max_iter`` rounds;
    a cluster that loses its rows keeps its centroid. Fewer distinct vectors
    than ``k`` give as many clusters.

    Vectors are counted first, so repeated ones (pixels) are computed once;
    null vectors are ignored."""
    spark = df.sparkSession
    points = materialize(df.select(F.col(vec_col).cast("array<double>").alias("x")).where("x is not null")
                         .groupBy("x").agg(F.count(F.lit(1)).alias("w")), "kmeans-points")
    centres: dict[int, np.ndarray] = {}
    for r in first_centroids(points, k, starts, seed).orderBy("start", "cluster").collect():  # starts x k rows
        centres.setdefault(r["start"], []).append(r["x"])
    centres = {s: np.array(c) for s, c in centres.items()}
    schema = "start int, cluster int, n double, total array<double>, cost double"

    def one_pass(some: dict[int, np.ndarray]) -> dict[int, list]:
        sent = spark.sparkContext.broadcast(some)
        width = next(iter(some.values())).shape[1]
        told = points.mapInPandas(_assigned(sent), schema).groupBy("start", "cluster").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(j))) for j in range(width)]).alias("total"), F.sum("cost").alias("cost"))
        out: dict[int, list] = {s: [None] * len(c) for s, c in some.items()}
        for r in told.collect():  # starts x k rows
            out[r["start"]][r["cluster"]] = r
        sent.destroy()
        return out

    moving = dict(centres)
    for _ in range(max_iter):
        if not moving:
            break
        told = one_pass(moving)
        for s, rows in told.items():
            new = np.array([np.array(r["total"]) / r["n"] if r["n"] else centres[s][r["cluster"]] for r in rows])
            moved, centres[s] = np.sqrt(((new - centres[s]) ** 2).sum(axis=1)).max(), new
            if moved <= tol:
                del moving[s]
            else:
                moving[s] = new
    if not centres:
        return spark.createDataFrame([], "start int, cluster int, centroid array<double>, n long, cost double, kept boolean")
    told = one_pass(centres)
    total = {s: sum(r["cost"] for r in rows) for s, rows in told.items()}
    best = min(sorted(total), key=total.get)
    return spark.createDataFrame([(s, r["cluster"], centres[s][r["cluster"]].tolist(), int(r["n"]), r["cost"], s == best) for s, rows in told.items() for r in rows],
                                 "start int, cluster int, centroid array<double>, n long, cost double, kept boolean")


def nearest_centroid(vec: Column, centroids: list[list[float]]) -> Column:
    """The place of the nearest centroid, the first of equally near ones."""
    def far(c):
        return F.aggregate(F.zip_with(vec, F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
    distances = F.array(*[far(c) for c in centroids])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")
