import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from playstream.operators import kmeans as K
from playstream.operators import mining as mn
from playstream.operators import trees as T
from playstream.operators.metrics import clustering as C


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.RandomState(0)
    x = np.round(rng.rand(600, 3) * 20)
    y = ((x[:, 0] > 9) ^ (x[:, 1] > 12)).astype(float) + (x[:, 2] > 15)
    return spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, y)], "a double, b double, c double, label double").cache()


def test_tree_table_and_expression_score_as_the_model(spark, points):
    names = ["a", "b", "c"]
    data = mn.assemble(points, names)
    model = DecisionTreeClassifier(maxDepth=6, labelCol="label").fit(data)
    nodes = T.tree_nodes(spark, model, names)
    rows = {r.node: r for r in nodes.collect()}
    assert len(rows) == model.numNodes and max(r.depth for r in rows.values()) == model.depth
    for i, r in rows.items():
        assert r.rows == sum(r.counts)
        if r.feature:
            assert r.rows == rows[2 * i].rows + rows[2 * i + 1].rows and r.gain > 0
    told, share = T.score_of(nodes)
    out = model.transform(data).select("*", told.alias("told"), share.alias("share"), T.leaf_of(nodes).alias("leaf"))
    assert out.where("told <> prediction").count() == 0
    assert all(np.allclose(r.share, r.probability.toArray()) for r in out.collect())
    assert {r.leaf: r["count"] for r in out.groupBy("leaf").count().collect()} == {i: r.rows for i, r in rows.items() if not r.feature}


def test_tree_of_one_leaf_and_null_values(spark):
    one = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "a double, label double")
    nodes = T.tree_nodes(spark, DecisionTreeClassifier(labelCol="label").fit(mn.assemble(one, ["a"])), ["a"])
    assert [(r.node, r.feature, r.rows) for r in nodes.collect()] == [(1, None, 2)]
    two = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0)], "a double, label double")
    nodes = T.tree_nodes(spark, DecisionTreeClassifier(labelCol="label").fit(mn.assemble(two, ["a"])), ["a"])
    assert [r[0] for r in spark.createDataFrame([(None,), (0.0,)], "a double").select(T.leaf_of(nodes)).collect()] == [3, 2]


def test_expression_of_a_large_tree_is_small(spark):
    rng = np.random.RandomState(3)
    df = spark.createDataFrame([(*map(float, r), float(rng.randint(3))) for r in rng.rand(700, 2)], "a double, b double, label double")
    data = mn.assemble(df, ["a", "b"])
    model = DecisionTreeClassifier(maxDepth=14, labelCol="label").fit(data)
    nodes = T.tree_nodes(spark, model, ["a", "b"])
    assert nodes.count() == model.numNodes > 200
    told, leaf = T.score_of(nodes)[0], T.leaf_of(nodes)
    assert max(str(c).count("WHEN") for c in (told, leaf)) <= 2  # once for each inner node before
    assert model.transform(data).where(told != F.col("prediction")).count() == 0


def test_surrogate_tree_is_fitted_on_all_rows(spark):
    n = 1_200_000
    df = spark.range(n).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("expert_0"))
    model = mn.fit_surrogate_tree(df, ["expert_0"], depths=(1,), min_leaf=(1,), impurities=("gini",), folds=2)
    root = T.tree_nodes(spark, model.bestModel.stages[-1], ["expert_0"]).where("node = 1").first()
    assert root["rows"] == n and root["counts"] == [n / 2, n / 2]


def test_weighted_precision(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0)], "label double, prediction double")
    assert T.weighted_precision(df).first()[0] == pytest.approx((2 * 0.5 + 2 * 2 / 3) / 5)


def lloyd(x, w, centres, rounds):
    for _ in range(rounds + 1):
        sq = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        at = sq.argmin(axis=1)
        last = centres
        centres = np.array([np.average(x[at == k], axis=0, weights=w[at == k]) if (at == k).any() else c for k, c in enumerate(centres)])
    return last, (w * sq.min(axis=1)).sum()


def test_starts_share_their_passes(spark):
    rng = np.random.RandomState(1)
    x = np.round(np.concatenate([rng.randn(150, 2) + c for c in ((0, 0), (9, 1), (4, 8))]), 1)
    df = spark.createDataFrame([(r.tolist(),) for r in x] + [([0.0, 0.0],)] * 40 + [(None,)], "x array<double>").repartition(4)
    out = K.multi_start_kmeans(df, "x", 3, starts=4, seed=7, max_iter=6, tol=0.0).collect()
    points = df.where("x is not null").groupBy("x").count().collect()
    px, pw = np.array([r.x for r in points]), np.array([r["count"] for r in points], dtype=float)
    first = K.first_centroids(df.where("x is not null").select("x").distinct(), 3, 4, 7).orderBy("start", "cluster").collect()
    costs = {}
    for s in range(4):
        centres, cost = lloyd(px, pw, np.array([r.x for r in first if r.start == s]), 6)
        mine = sorted((r for r in out if r.start == s), key=lambda r: r.cluster)
        assert np.allclose([r.centroid for r in mine], centres) and sum(r.cost for r in mine) == pytest.approx(cost)
        assert sum(r.n for r in mine) == 490
        costs[s] = cost
    assert {r.start for r in out if r.kept} == {min(costs, key=costs.get)}
    told = mn.quantise(df.where("x is not null"), "x", 3, seed=7, attempts=4, max_iter=6, tol=0.0, to_bytes=True).collect()
    assert len(told) == 490 and all(v == int(v) for r in told for v in r.centroid)
    assert mn.quantise(df.where("false"), "x", 3).count() == 0
    assert K.multi_start_kmeans(df, "x", 3, starts=1, max_iter=50, tol=0.2).count() == 3
    assert K.multi_start_kmeans(spark.createDataFrame([([1.0],)], "x array<double>"), "x", 5, starts=2).count() == 2  # fewer points than clusters


def test_silhouette_rows_against_every_pair(spark, monkeypatch):
    rng = np.random.RandomState(5)
    x = rng.randn(120, 4).round(2)
    x[60:70] = x[3]  # copies
    k = rng.randint(0, 3, 120)
    k[0] = 9  # a cluster of one
    df = spark.createDataFrame([(i, r.tolist(), int(c)) for i, (r, c) in enumerate(zip(x, k))] + [(900, None, 1), (901, [0.0] * 4, None)],
                               "id long, features array<double>, label int").repartition(5)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))

    def one(i):
        b = min(d[i, k == c].mean() for c in set(k) - {k[i]})
        n = (k == k[i]).sum()
        a = d[i, k == k[i]].sum() / (n - 1) if n > 1 else None
        return (None, b, 0.0) if a is None else (a, b, (b - a) / max(a, b))
    want = {i: one(i) for i in range(0, 120, 3)}
    for size in (16 << 20, 300):  # one block, many blocks
        monkeypatch.setattr(C, "SCORED_BYTES", size)
        got = {r.id: (r.a, r.b, r.s) for r in C.silhouette_rows(df, F.col("id") % 3 == 0).collect() if r.id < 900}
        assert set(got) == set(want)
        for i, w in want.items():
            assert got[i] == pytest.approx(w)
    alone = C.silhouette_rows(df.where("label = 1 and id < 900"), F.col("id") % 3 == 0).collect()
    assert alone and all(r.b is None and r.s is None for r in alone)
    assert C.silhouette_rows(df.where("false"), F.col("id") % 3 == 0).collect() == []
