"""Classification metrics (EV-04 .. EV-08).

Everything starts from the confusion table ``groupBy(true, pred).count()``:
a partial aggregate whose size is bounded by classes x classes, so the
per-class sums after it are tiny whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import materialize


def confusion(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
              classes: list | None = None) -> DataFrame:
    """EV-05: long form (y_true, y_pred, count), or wide with one column per
    predicted class when the class list is given."""
    long = df.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")) \
             .agg(F.count(F.lit(1)).alias("count"))
    if classes is None:
        return long
    return long.groupBy("y_true").pivot("y_pred", list(classes)).agg(F.first("count")).na.fill(0)


def per_class_counts(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Per class in the union of true and predicted labels: tp, fp, fn and
    support, plus the total n (one row per class). The confusion table is
    written once; the marginals and the total read only it."""
    cm = materialize(confusion(df, y_true, y_pred), "confusion")
    by_true = cm.groupBy(F.col("y_true").alias("class")).agg(
        F.sum("count").alias("support"),
        F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("count")).otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("y_pred").alias("class")).agg(F.sum("count").alias("predicted"))
    per = by_true.join(by_pred, "class", "full_outer").na.fill(0, ["support", "tp", "predicted"])
    n = cm.agg(F.sum("count")).scalar()
    return per.select("class", "tp", (F.col("predicted") - F.col("tp")).alias("fp"),
                      (F.col("support") - F.col("tp")).alias("fn"), "support",
                      n.alias("n"))


def _prf(per: DataFrame) -> DataFrame:
    """precision / recall / f1 per class; 0 where undefined (scikit-learn's
    zero_division behaviour)."""
    prec = F.coalesce(F.try_divide(F.col("tp"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    out = per.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return out.withColumn("f1", f1)


def classification_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                           average: str = "weighted") -> DataFrame:
    """EV-04: one row: accuracy, precision, recall, f1 averaged by
    ``average`` = weighted (by support, default) | macro | micro."""
    per = _prf(per_class_counts(df, y_true, y_pred))
    if average == "macro":
        agg = per.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                      F.avg("f1").alias("f1"), F.try_divide(F.sum("tp"), F.first("n").cast("double")).alias("accuracy"))
    elif average == "weighted":
        w = F.col("support")
        agg = per.agg(*[(F.sum(F.col(m) * w) / F.sum(w)).alias(m) for m in ("precision", "recall", "f1")],
                      F.try_divide(F.sum("tp"), F.first("n").cast("double")).alias("accuracy"))
    elif average == "micro":
        acc = F.try_divide(F.sum("tp"), F.first("n").cast("double"))
        agg = per.agg(acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), acc.alias("accuracy"))
    else:
        raise ValueError("average must be weighted, macro or micro")
    return agg.select("accuracy", "precision", "recall", "f1")


def hard_auc(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """EV-06: ROC AUC of hard 0/1 predictions = (TPR + TNR) / 2; 0 when the
    truth has a single class (the reference's rule)."""
    t, p = F.col(y_true), F.col(y_pred)
    c = df.agg(F.count_if((t == 1) & (p == 1)).alias("tp"), F.count_if((t == 1) & (p != 1)).alias("fn"),
               F.count_if((t != 1) & (p == 1)).alias("fp"), F.count_if((t != 1) & (p != 1)).alias("tn"))
    pos, neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    return c.select(F.when((pos == 0) | (neg == 0), F.lit(0.0))
                    .otherwise((F.col("tp") / pos + F.col("tn") / neg) / 2).alias("roc_auc"))


def per_class_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                     digits: int = 2) -> DataFrame:
    """EV-07: one-vs-rest precision, recall, f1_score, accuracy, auc_roc per
    class (union of true and predicted labels), rounded half-even to
    ``digits``; auc_roc is null when the class is constant in the truth.
    A last row with a null class holds the mean of the rounded values
    (nulls skipped), as the reference's macro row does."""
    per = _prf(per_class_counts(df, y_true, y_pred))
    tn = F.col("n") - F.col("tp") - F.col("fp") - F.col("fn")
    pos, neg = F.col("tp") + F.col("fn"), tn + F.col("fp")
    auc = F.when((pos == 0) | (neg == 0), F.lit(None).cast("double")) \
           .otherwise((F.col("tp") / pos + tn / neg) / 2)
    rows = per.select(
        F.col("class").cast("string").alias("class"),
        F.bround("precision", digits).alias("precision"),
        F.bround("recall", digits).alias("recall"),
        F.bround("f1", digits).alias("f1_score"),
        F.bround((F.col("tp") + tn) / F.col("n"), digits).alias("accuracy"),
        F.bround(auc, digits).alias("auc_roc"),
    )
    macro = rows.agg(F.lit(None).cast("string").alias("class"),
                     *[F.avg(c).alias(c) for c in ("precision", "recall", "f1_score", "accuracy", "auc_roc")])
    return rows.unionByName(macro)


def ordinal_errors(df: DataFrame, diff: str = "diff") -> tuple[DataFrame, DataFrame]:
    """EV-08: (histogram of positive differences: diff, count) and one
    summary row: error_mean (of positive diffs), error_rate (% of rows with
    a positive diff), overall_mean."""
    d = F.col(diff)
    hist = df.filter(d > 0).groupBy(d.alias("diff")).agg(F.count(F.lit(1)).alias("count"))
    summary = df.agg(
        F.avg(F.when(d > 0, d)).alias("error_mean"),
        (F.try_divide(F.count_if(d > 0), F.count(F.lit(1)).cast("double")) * 100).alias("error_rate"),
        F.avg(d).alias("overall_mean"),
    )
    return hist, summary
