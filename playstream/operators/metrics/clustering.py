"""Clustering metrics (EV-09 .. EV-13).

External scores come from the contingency table ``groupBy(truth, label)``
(classes x clusters cells). Internal scores keep vectors as they are:
one aggregate gives the centroid of each cluster as an array, one narrow pass
the distances to it. Only the centroids are taken apart by dimension.
Formulas and edge cases follow scikit-learn's definitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...session import materialize


def contingency(df: DataFrame, labels: str = "label", truth: str = "truth") -> DataFrame:
    return df.groupBy(F.col(truth).alias("c"), F.col(labels).alias("k")).agg(
        F.count(F.lit(1)).cast("double").alias("nij"))


def clustering_external(df: DataFrame, labels: str = "label", truth: str = "truth") -> DataFrame:
    """EV-09: one row: adjusted_rand, normalized_mutual_info (arithmetic),
    homogeneity, completeness, v_measure. 0 * log 0 = 0.

    One pass over the rows builds the contingency table (written once);
    every score below reads only that small table."""
    ct = materialize(contingency(df, labels, truth), "contingency")
    a = ct.groupBy("c").agg(F.sum("nij").alias("ai"))
    b = ct.groupBy("k").agg(F.sum("nij").alias("bj"))
    n = ct.agg(F.sum("nij")).scalar()
    cells = ct.join(a, "c").join(b, "k")
    mi_term = (F.col("nij") / n) * (F.log("nij") + F.log(n) - F.log("ai") - F.log("bj"))
    mi = F.greatest(cells.agg(F.sum(mi_term)).scalar(), F.lit(0.0))
    h_c = a.agg(-F.sum((F.col("ai") / n) * F.log(F.col("ai") / n))).scalar()
    h_k = b.agg(-F.sum((F.col("bj") / n) * F.log(F.col("bj") / n))).scalar()
    n_c, n_k = a.agg(F.count(F.lit(1))).scalar(), b.agg(F.count(F.lit(1))).scalar()
    sum_sq = ct.agg(F.sum(F.col("nij") * F.col("nij"))).scalar()
    sum_a2 = a.agg(F.sum(F.col("ai") * F.col("ai"))).scalar()
    sum_b2 = b.agg(F.sum(F.col("bj") * F.col("bj"))).scalar()
    # pair confusion: same/different cluster x same/different class
    tp, fp, fn = sum_sq - n, sum_b2 - sum_sq, sum_a2 - sum_sq
    tn = n * n - fp - fn - sum_sq
    ari = (F.when((fn == 0) & (fp == 0), F.lit(1.0))
           .otherwise(2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))))
    homog = F.when(h_c == 0, F.lit(1.0)).otherwise(mi / h_c)
    compl = F.when(h_k == 0, F.lit(1.0)).otherwise(mi / h_k)
    nmi = (F.when(((n_c == 1) & (n_k == 1)) | ((n_c == 0) & (n_k == 0)), F.lit(1.0))
           .when(mi == 0, F.lit(0.0))
           .otherwise(mi / ((h_c + h_k) / 2)))
    one = ct.sparkSession.range(1)
    out = one.select(ari.alias("adjusted_rand"), nmi.alias("normalized_mutual_info"),
                     homog.alias("homogeneity"), compl.alias("completeness"))
    v = F.when(F.col("homogeneity") + F.col("completeness") == 0, F.lit(0.0)).otherwise(
        2 * F.col("homogeneity") * F.col("completeness") / (F.col("homogeneity") + F.col("completeness")))
    return out.withColumn("v_measure", v)


def clustering_internal(df: DataFrame, vec: str = "features", labels: str = "label") -> DataFrame:
    """EV-10 / EV-11: one row: calinski_harabasz, davies_bouldin; null when
    there is a single cluster. Rows need no id.

    Per cluster: the mean vector (a partial aggregate), then, joined back on
    the cluster, the sums of squared distances and of distances. Davies-Bouldin
    compares centroids with each other (clusters x clusters rows), so
    ``labels`` must be a column of clusters, not of row ids."""
    pts = df.select(F.col(labels).alias("k"), F.col(vec).cast("array<double>").alias("x")).where("k is not null")
    mean = materialize(pts.groupBy("k").agg(
        vector_to_array(Summarizer.mean(array_to_vector("x"))).alias("c"), F.count(F.lit(1)).alias("nk")), "centroids")
    diff = F.zip_with("x", "c", lambda x, c: (x - c) * (x - c))
    dist = pts.join(mean.select("k", "c"), "k").select("k", F.aggregate(diff, F.lit(0.0), lambda a, d: a + d).alias("ss"))
    per_k = materialize(dist.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ss").alias("ss"), F.avg(F.sqrt("ss")).alias("s")), "cluster-dist")
    cent = mean.select("k", "nk", F.posexplode("c").alias("d", "ck"))
    n = per_k.agg(F.sum("n")).scalar()
    k = per_k.agg(F.count(F.lit(1))).scalar()
    intra = per_k.agg(F.sum("ss")).scalar()
    glob = cent.groupBy("d").agg((F.sum(F.col("nk") * F.col("ck")) / F.sum("nk")).alias("g"))
    extra = cent.join(glob, "d").agg(F.sum(F.col("nk") * (F.col("ck") - F.col("g")) ** 2)).scalar()
    ch = (F.when(k < 2, F.lit(None).cast("double"))
          .when(intra == 0, F.lit(1.0))
          .otherwise(extra * (n - k) / (intra * (k - 1))))
    s = per_k.select("k", "s")
    other = cent.select(F.col("k").alias("l"), "d", F.col("ck").alias("cl"))
    m = (cent.join(other, "d").filter(F.col("k") != F.col("l"))
             .groupBy("k", "l").agg(F.sqrt(F.sum((F.col("ck") - F.col("cl")) ** 2)).alias("m")))
    sl = s.select(F.col("k").alias("l"), F.col("s").alias("sl"))
    ratio = (m.join(s, "k").join(sl, "l")
              .withColumn("r", F.when(F.col("m") == 0, F.lit(0.0))
                          .otherwise((F.col("s") + F.col("sl")) / F.col("m"))))
    worst = ratio.groupBy("k").agg(F.max("r").alias("r"))
    all_zero = (s.agg(F.max("s")).scalar() == 0) | (m.agg(F.max("m")).scalar() == 0)
    db = (F.when(k < 2, F.lit(None).cast("double"))
          .when(all_zero, F.lit(0.0))
          .otherwise(worst.agg(F.avg("r")).scalar()))
    return df.sparkSession.range(1).select(ch.alias("calinski_harabasz"), db.alias("davies_bouldin"))


def silhouette(df: DataFrame, vec: str = "features", labels: str = "label",
               distance: str = "squaredEuclidean") -> DataFrame:
    """EV-12: Spark's distributed silhouette (squared Euclidean or cosine),
    O(rows x clusters). Not the pairwise Euclidean silhouette of the
    reference, which needs every pair of rows. Null for a single cluster."""
    data = df.select(array_to_vector(F.col(vec).cast("array<double>")).alias("_v"),
                     F.col(labels).cast("double").alias("_k"))
    n_k = data.select("_k").distinct().limit(2).count()
    value = None
    if n_k > 1:
        value = ClusteringEvaluator(featuresCol="_v", predictionCol="_k",
                                    distanceMeasure=distance).evaluate(data)
    return df.sparkSession.range(1).select(F.lit(value).cast("double").alias("silhouette"))


#: Bytes of the scored rows that one pass sends to all executors.
SCORED_BYTES = 16 << 20
#: Rows of either side of which all distances are held at once.
SIDE = 1024


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances by a matrix product; where rows are so near that
    the product cancels, by their differences."""
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    sq = np.maximum(xx[:, None] + yy - 2 * (x @ y.T), 0)
    i, j = np.nonzero(sq < 1e-6 * (xx[:, None] + yy))
    sq[i, j] = ((x[i] - y[j]) ** 2).sum(axis=1)
    return np.sqrt(sq)


def _distance_sums(shared):
    """Per scored row and cluster: the distances to the rows that a task
    reads, summed, and their number."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vecs, names = shared.value
        place = {k: i for i, k in enumerate(names)}
        sums, counts = np.zeros((len(ids), len(names))), np.zeros(len(names), dtype=np.int64)
        for pdf in batches:
            k = pdf["k"].map(place).to_numpy(np.int64)
            counts += np.bincount(k, minlength=len(names))
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, vecs.shape[1]))
            for s in range(0, len(x), SIDE):
                member = np.eye(len(names))[k[s:s + SIDE]]
                for q in range(0, len(ids), SIDE):
                    sums[q:q + SIDE] += _distances(vecs[q:q + SIDE], x[s:s + SIDE]) @ member
        i, c = np.nonzero(np.broadcast_to(counts > 0, sums.shape))
        yield pd.DataFrame({"id": ids[i], "c": [names[j] for j in c], "d": sums[i, c], "n": counts[c]})
    return run


def silhouette_rows(df: DataFrame, scored: Column, vec: str = "features", labels: str = "label",
                    id_col: str = "id") -> DataFrame:
    """EV-12 with Euclidean distances: per row for which ``scored`` (a
    condition on the id), ``id``, ``a`` (mean distance to the other rows of
    its cluster), ``b`` (least mean distance to another cluster) and ``s``
    ``= (b - a) / max(a, b)``, 0 for a cluster of one, null if there is only
    one cluster.

    The scored rows are sent to all executors in blocks of a fixed size, and
    one scan of all rows serves a block: each task adds up its distances per
    (scored row, cluster), so no pair of rows ever leaves a task, and the
    exchange holds blocks x clusters sums a task. ``labels`` is a column of
    clusters (few), ``id_col`` is unique, and vectors have one length; rows
    without a cluster or vector take no part."""
    pts = df.select(F.col(id_col).alias("id"), F.col(labels).alias("k"), F.col(vec).cast("array<double>").alias("x")).where("k is not null and x is not null")
    spark, kind = df.sparkSession, dict(pts.dtypes)
    names = sorted(r["k"] for r in pts.select("k").distinct().collect())  # clusters
    chosen = materialize(pts.where(scored), "scored")
    n, width = chosen.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    parts = math.ceil(n * (8 * (width or 0) + 32) / SCORED_BYTES)
    sums = None
    for part in range(parts):
        block = chosen.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).select("id", "x").toPandas()
        if len(block):
            sent = spark.sparkContext.broadcast((block["id"].to_numpy(), np.stack(block["x"].to_numpy()), names))
            told = materialize(pts.select("k", "x").mapInPandas(_distance_sums(sent), f"id {kind['id']}, c {kind['k']}, d double, n long")
                               .groupBy("id", "c").agg(F.sum("d").alias("d"), F.sum("n").alias("n")), "distance-sums")
            sent.destroy()
            sums = told if sums is None else sums.unionAll(told)
    if sums is None:
        return spark.createDataFrame([], f"id {kind['id']}, a double, b double, s double")
    own = F.col("c") == F.col("k")
    per = sums.join(chosen.select("id", "k"), "id").groupBy("id").agg(
        F.max(F.when(own, F.col("n"))).alias("size"), F.max(F.when(own, F.try_divide(F.col("d"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("d") / F.col("n"))).alias("b"))
    s = F.when(F.col("b").isNotNull(), F.when(F.col("size") == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))))
    return per.select("id", "a", "b", s.alias("s"))


EXTERNAL = ("adjusted_rand", "normalized_mutual_info", "homogeneity", "completeness", "v_measure")


def clustering_report(df: DataFrame, vec: str = "features", labels: str = "label",
                      truth: str | None = None) -> DataFrame:
    """One row with the internal scores and the silhouette, and with the
    external scores, which are null without a ``truth`` column. The three
    parts are one row each and are computed when this is called."""
    parts = [clustering_internal(df, vec, labels), silhouette(df, vec, labels)]
    parts += [clustering_external(df, labels, truth)] if truth else []
    told = dict.fromkeys(EXTERNAL) | {c: v for p in parts for c, v in p.first().asDict().items()}
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(c) for c, v in told.items()])
