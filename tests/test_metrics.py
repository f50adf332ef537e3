"""Metrics against brute-force definitions on small fixtures."""

import math
import random
from collections import Counter

from playstream.operators.metrics import classification as cl
from playstream.operators.metrics import clustering as cu
from playstream.operators.metrics import regression as rg
from playstream.operators.metrics.registry import register


def close(a, b, tol=1e-9):
    return (a is None and b is None) or abs(a - b) <= tol * max(1.0, abs(b))


def test_regression_metrics(spark):
    random.seed(1)
    rows = [(random.uniform(1, 100), random.uniform(1, 100)) for _ in range(300)]
    r = rg.regression_metrics(spark.createDataFrame(rows, "y_true double, y_pred double"), n_features=2).first()
    n = len(rows)
    mt = sum(t for t, _ in rows) / n
    ss_res = sum((p - t) ** 2 for t, p in rows)
    ss_tot = sum((t - mt) ** 2 for t, _ in rows)
    r2 = 1 - ss_res / ss_tot
    assert close(r["mae"], sum(abs(p - t) for t, p in rows) / n)
    assert close(r["mse"], ss_res / n) and close(r["rmse"], math.sqrt(ss_res / n))
    assert close(r["r2"], r2)
    assert close(r["mape"], sum(abs((t - p) / t) for t, p in rows) / n * 100)
    assert close(r["adjusted_r2"], 1 - (1 - r2) * (n - 1) / (n - 3))


def test_error_distribution_legacy_bins(spark):
    rows = [(float(t), float(t) + (t % 3)) for t in range(1, 101)]
    out = {r["bin"]: r for r in rg.error_distribution(
        spark.createDataFrame(rows, "y_true double, y_pred double"), bins=5).collect()}
    w = (100 - 1) / 5
    for i in range(1, 5):
        errs = [abs(p - t) for t, p in rows if w * (i - 1) < t <= w * i]
        assert out[i]["n_sample"] == len(errs)
        assert close(out[i]["mean"], sum(errs) / len(errs))
    assert 5 not in out


def test_error_distribution_constant_truth(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 7.0)], "y_true double, y_pred double")
    assert rg.error_distribution(df, bins=5).count() == 0
    full = rg.error_distribution(df, bins=5, legacy_bins=False).collect()
    assert [(r["bin"], r["n_sample"]) for r in full] == [(1, 2)]


def brute_prf(pairs):
    classes = sorted({t for t, _ in pairs} | {p for _, p in pairs})
    res = {}
    for c in classes:
        tp = sum(1 for t, p in pairs if t == c and p == c)
        fp = sum(1 for t, p in pairs if t != c and p == c)
        fn = sum(1 for t, p in pairs if t == c and p != c)
        pr = tp / (tp + fp) if tp + fp else 0.0
        rc = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        res[c] = (pr, rc, f1, tp + fn)
    return res


def test_classification_averages(spark):
    random.seed(2)
    pairs = [(random.choice("abcd"), random.choice("abcde")) for _ in range(400)]
    df = spark.createDataFrame(pairs, "y_true string, y_pred string")
    per = brute_prf(pairs)
    n = len(pairs)
    acc = sum(t == p for t, p in pairs) / n
    w = cl.classification_metrics(df, average="weighted").first()
    m = cl.classification_metrics(df, average="macro").first()
    mi = cl.classification_metrics(df, average="micro").first()
    assert close(w["accuracy"], acc) and close(mi["f1"], acc)
    assert close(w["precision"], sum(v[0] * v[3] for v in per.values()) / n)
    assert close(m["f1"], sum(v[2] for v in per.values()) / len(per))


def test_empty_inputs_give_nulls_not_errors(spark):
    empty = spark.createDataFrame([], "y_true string, y_pred string, diff int")
    assert cl.ordinal_errors(empty)[1].first()["error_rate"] is None
    assert cl.classification_metrics(empty.select("y_true", "y_pred")).count() == 1


def test_hard_auc_and_single_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y_true int, y_pred int")
    assert close(cl.hard_auc(df).first()[0], (1 / 2 + 2 / 3) / 2)
    one = spark.createDataFrame([(1, 1), (1, 0)], "y_true int, y_pred int")
    assert cl.hard_auc(one).first()[0] == 0.0


def test_per_class_report_macro_row(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")]
    rows = cl.per_class_report(spark.createDataFrame(pairs, "y_true string, y_pred string")).collect()
    by = {r["class"]: r for r in rows}
    assert by["a"]["precision"] == 1.0 and by["a"]["recall"] == 0.5
    assert by["c"]["auc_roc"] == 0.5
    assert close(by[None]["precision"], (by["a"]["precision"] + by["b"]["precision"] + by["c"]["precision"]) / 3)


def entropy(counts, n):
    return -sum(c / n * math.log(c / n) for c in counts if c)


def test_external_clustering(spark):
    random.seed(4)
    rows = [(random.randint(0, 3), random.randint(0, 2)) for _ in range(300)]
    r = cu.clustering_external(spark.createDataFrame(rows, "truth int, label int")).first()
    n = len(rows)
    nij = Counter(rows)
    a = Counter(t for t, _ in rows)
    b = Counter(k for _, k in rows)
    mi = sum(v / n * math.log(v * n / (a[t] * b[k])) for (t, k), v in nij.items())
    hc, hk = entropy(a.values(), n), entropy(b.values(), n)
    assert close(r["homogeneity"], mi / hc) and close(r["completeness"], mi / hk)
    assert close(r["normalized_mutual_info"], mi / ((hc + hk) / 2))
    comb = lambda x: x * (x - 1) / 2
    sij = sum(comb(v) for v in nij.values())
    sa, sb = sum(comb(v) for v in a.values()), sum(comb(v) for v in b.values())
    exp = sa * sb / comb(n)
    assert close(r["adjusted_rand"], (sij - exp) / ((sa + sb) / 2 - exp))


def test_internal_clustering(spark):
    random.seed(6)
    rows = [(i, i % 3, [random.gauss(i % 3, 1.0), random.gauss(-(i % 3), 0.5)]) for i in range(120)]
    r = cu.clustering_internal(spark.createDataFrame(rows, "id int, label int, features array<double>")).first()
    groups = {}
    for _, k, x in rows:
        groups.setdefault(k, []).append(x)
    cent = {k: [sum(v[d] for v in xs) / len(xs) for d in range(2)] for k, xs in groups.items()}
    g = [sum(x[d] for _, _, x in rows) / len(rows) for d in range(2)]
    sq = lambda u, v: sum((a - b) ** 2 for a, b in zip(u, v))
    extra = sum(len(xs) * sq(cent[k], g) for k, xs in groups.items())
    intra = sum(sq(x, cent[k]) for _, k, x in rows)
    ch = extra * (len(rows) - 3) / (intra * 2)
    s = {k: sum(math.sqrt(sq(x, cent[k])) for x in xs) / len(xs) for k, xs in groups.items()}
    db = sum(max((s[k] + s[l]) / math.sqrt(sq(cent[k], cent[l])) for l in groups if l != k)
             for k in groups) / 3
    assert close(r["calinski_harabasz"], ch, 1e-8) and close(r["davies_bouldin"], db, 1e-8)


def test_registry_union(spark):
    a = spark.createDataFrame([(0.123456, 1.0)], "mae double, r2 double")
    b = spark.createDataFrame([(0.5,)], "accuracy double")
    reg = register(register(None, "x", a), "y", b)
    rows = {r["algorithm"]: r for r in reg.collect()}
    assert rows["x"]["mae"] == 0.1235 and rows["x"]["accuracy"] is None and rows["y"]["accuracy"] == 0.5
