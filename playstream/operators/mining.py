"""Pattern mining and models (ML-02 .. ML-09) on Spark ML.

FP-Growth (parallel FP-growth), random forests, decision trees and k-means
are Spark ML's distributed implementations; model fitting is eager by
nature, everything after it is lazy. Exact AUC is a distributed aggregate.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .index import with_running_sum
from .kmeans import multi_start_kmeans, nearest_centroid

# Fixed values of the reference's mining and model settings.
MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.6
NUM_TREES = 50
DEPTH_GRID = (3, 5, 7)
NUM_FOLDS = 3
#: Training rows that a forest is fitted on; of more, a sample by hash.
FIT_ROWS = 1_000_000


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, chosen by a hash of their values and
    place, or all if there are no more."""
    n = df.count()
    if n <= rows:
        return df
    place = F.xxhash64(*df.columns, F.monotonically_increasing_id())
    return df.where(F.pmod(place, F.lit(1_000_000)) < int(1_000_000 * rows / n))


def fit_fpgrowth(baskets: DataFrame, items_col: str = "features",
                 min_support: float = MIN_SUPPORT,
                 min_confidence: float = MIN_CONFIDENCE,
                 num_partitions: int | None = None) -> FPGrowthModel:
    """ML-02: the baskets are written once: the fit counts them and their items,
    and the model's itemsets and rules, which are lazy, read them again each.
    The fit keeps them as compressed columns on disk, not as arrays in memory."""
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support,
                  minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    stored = materialize(baskets.select(items_col), "baskets").persist(StorageLevel.DISK_ONLY)
    try:
        return fp.fit(stored)
    finally:
        stored.unpersist()


def frequent_itemsets(model: FPGrowthModel, min_size: int = 2) -> DataFrame:
    """ML-02: itemsets (sorted) with their frequency, size >= ``min_size``."""
    return (model.freqItemsets
            .filter(F.size("items") >= min_size)
            .select(F.sort_array("items").alias("items"), "freq"))


def association_rules(model: FPGrowthModel) -> DataFrame:
    """ML-03: rules by confidence (antecedent sorted; consequent is one item)."""
    return (model.associationRules
            .select(F.sort_array("antecedent").alias("antecedent"),
                    F.sort_array("consequent").alias("consequent"),
                    "confidence", "lift", "support")
            .orderBy(F.desc("confidence")))


def index_labels(df: DataFrame, input_col: str = "label_str",
                 output_col: str = "label") -> DataFrame:
    """ML-04: label index by descending frequency, ties alphabetical. Fitting
    collects one count per distinct label (bounded by the label set)."""
    return (StringIndexer(inputCol=input_col, outputCol=output_col,
                          stringOrderType="frequencyDesc")
            .fit(df).transform(df))


def assemble(df: DataFrame, cols: list[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """ML-05."""
    return VectorAssembler(inputCols=cols, outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def fit_policy_model(df: DataFrame, seed: int = 42, num_trees: int = NUM_TREES,
                     depths=DEPTH_GRID, folds: int = NUM_FOLDS,
                     test_fraction: float = 0.2, parallelism: int = 3, test: str | None = None,
                     fit_rows: int = FIT_ROWS, written: bool = False):
    """ML-06: random forest on (player_total, dealer_card) -> action, depth
    chosen by 3-fold cross-validated AUC. Unlike the reference it holds out
    a test split (the rows where column ``test`` is true, else a seeded
    fraction) and scores that (Q18). At most about ``fit_rows`` training rows
    are fitted on; all held-out rows are scored. Returns (model, test scored).

    The input is written once before fitting (unless it is ``written``, a
    stored table), and so are the rows that are fitted on: cross-validation
    fits folds x grid + 1 forests, and each would otherwise recompute the
    upstream lineage or choose its rows from all of the input again."""
    keep = [test] if test else []
    df = df.select("player_total", "dealer_card", "label_str", *keep)
    df = df if written else materialize(df, "policy-input")
    data = assemble(index_labels(df), ["player_total", "dealer_card"]).select("features", "label", *keep)
    train, held = ((data.where(~F.col(test)), data.where(F.col(test))) if test
                   else data.randomSplit([1 - test_fraction, test_fraction], seed=seed))
    rf = RandomForestClassifier(labelCol="label", featuresCol="features",
                                numTrees=num_trees, seed=seed)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, list(depths)).build()
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid,
                        evaluator=BinaryClassificationEvaluator(), numFolds=folds,
                        seed=seed, parallelism=parallelism)
    model = cv.fit(materialize(_bounded(train, fit_rows), "policy-fit"))
    return model, model.transform(held)


def evaluator_auc(scored: DataFrame, label_col: str = "label",
                  raw_col: str = "rawPrediction") -> float:
    """ML-07 the reference's way (curve down-sampled to 1000 bins)."""
    return BinaryClassificationEvaluator(labelCol=label_col,
                                         rawPredictionCol=raw_col).evaluate(scored)


def auc(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """ML-07 exact: area under ROC as P(score_pos > score_neg) + P(tie)/2.

    One row per distinct score (a partial aggregate), running negative counts
    in score order by range partitions (no single-task window), then one
    global aggregate. Null when a class is absent. Rows without a score or
    a 0/1 label cannot be ranked and do not take part."""
    df = df.filter(F.col(score_col).isNotNull() & F.col(label_col).isin(0, 1))
    per_score = df.groupBy(F.col(score_col).alias("_s")).agg(
        F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label_col) == 0, 1).otherwise(0)).alias("neg"))
    cum = with_running_sum(per_score, "_s", ["neg"])
    return cum.agg(F.try_divide(
        F.sum(F.col("pos") * (F.col("neg_cum") - F.col("neg") + F.col("neg") * 0.5)),
        F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def fit_surrogate_tree(df: DataFrame, feature_cols: list[str], label_col: str = "label",
                       depths=(3, 10, 20), min_leaf=(1, 5), impurities=("gini", "entropy"),
                       folds: int = 3, seed: int = 42, parallelism: int = 2):
    """ML-08: decision tree over per-expert columns; depth, leaf size and
    criterion chosen by cross-validated weighted precision. (The reference's
    ``min_samples_split`` has no Spark counterpart.) All rows are fitted on;
    they are written once, as folds x grid + 1 fits read them. A tree grows
    on the driver, with up to as many nodes as rows, so only ``parallelism`` of
    them grow at a time, and rows remember their nodes, so that no pass over
    them ships the tree.
    ``operators.trees`` gives the fitted tree as a table and an expression."""
    df = materialize(df.select(label_col, *feature_cols), "tree-input")
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features")
    dt = DecisionTreeClassifier(labelCol=label_col, featuresCol="features", seed=seed, cacheNodeIds=True)
    grid = (ParamGridBuilder().addGrid(dt.maxDepth, list(depths))
            .addGrid(dt.minInstancesPerNode, list(min_leaf))
            .addGrid(dt.impurity, list(impurities)).build())
    cv = CrossValidator(estimator=Pipeline(stages=[assembler, dt]),
                        estimatorParamMaps=grid,
                        evaluator=MulticlassClassificationEvaluator(
                            labelCol=label_col, metricName="weightedPrecision"),
                        numFolds=folds, seed=seed, parallelism=parallelism)
    return cv.fit(df)


def quantise(df: DataFrame, vec_col: str, k: int, seed: int = 1,
             max_iter: int = 100, tol: float = 0.2, attempts: int = 10,
             to_bytes: bool = False) -> DataFrame:
    """ML-09: k-means quantisation; each row gets its cluster and centroid.
    Of ``attempts`` starts, which share each pass over the rows
    (``multi_start_kmeans``), the one of least cost is kept; ``to_bytes``
    truncates centroids to whole values, as pixels have them. The k centroids
    are part of the expression, so nothing is joined."""
    found = multi_start_kmeans(df, vec_col, k, attempts, seed, max_iter, tol).where("kept").orderBy("cluster").collect()  # k rows
    if not found:
        return df.withColumn("cluster", F.lit(None).cast("int")).withColumn("centroid", F.lit(None).cast("array<double>"))
    centres = [r["centroid"] for r in found]
    told = F.array(*[F.array(*[F.lit(float(int(x)) if to_bytes else x) for x in c]) for c in centres])
    near = nearest_centroid(F.col(vec_col).cast("array<double>"), centres)
    return df.withColumn("cluster", near).withColumn("centroid", F.get(told, F.col("cluster")))

