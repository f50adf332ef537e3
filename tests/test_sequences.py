"""Decision steps, baskets and mining."""

from pyspark.sql import functions as F

from conftest import SF001
from playstream.operators import mining as mn
from playstream.operators.sequences import decision_steps, to_basket
from playstream.sources import fixtures as fx
from test_episodes import games


def reference_steps(shown, hands):
    """The reference's walk, written out in Python for a brute-force check."""
    seq = []
    for h in [shown] + hands:
        if h is None:
            break
        seq.append(h)
    out = []
    for i, h in enumerate(seq):
        total = h[0] if len(h) else None
        if i + 1 < len(seq):
            nxt = seq[i + 1][0] if len(seq[i + 1]) else None
            action = "hit" if nxt != total else "stand"
        else:
            action = "stand"
        out.append((i, total, action))
        if action == "stand":
            break
    return out


def test_steps_match_the_walk_on_edge_games(spark):
    from test_episodes import EDGE
    got = {}
    for r in decision_steps(games(spark, EDGE), 3).collect():
        got.setdefault(r["l_orderkey"], []).append((r["step"], r["player_total"], r["action"]))
    for key, shown, *hands in EDGE:
        assert sorted(got.get(key, [])) == reference_steps(shown, hands), key


def test_one_stand_per_game_and_last(spark):
    steps = decision_steps(fx.play_games(spark, SF001), fx.PLAY_HANDS)
    per_game = steps.groupBy("l_orderkey").agg(
        F.count_if(F.col("action") == "stand").alias("stands"),
        F.max("step").alias("last"),
        F.max(F.when(F.col("action") == "stand", F.col("step"))).alias("stand_step"))
    assert per_game.filter((F.col("stands") != 1) | (F.col("last") != F.col("stand_step"))).count() == 0
    assert per_game.count() == fx.play_games(spark, SF001).count()


def test_itemset_supports_are_exact(spark):
    baskets = to_basket(decision_steps(fx.play_games(spark, SF001), fx.PLAY_HANDS)).cache()
    model = mn.fit_fpgrowth(baskets)
    n = baskets.count()
    for r in mn.frequent_itemsets(model).collect():
        items = r["items"]
        cond = F.lit(True)
        for it in items:
            cond = cond & F.array_contains("features", it)
        assert baskets.filter(cond).count() == r["freq"] >= 0.02 * n
    for r in mn.association_rules(model).collect():
        assert r["confidence"] >= 0.6


def test_itemsets_read_the_baskets_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    rows = [(["a", "b", f"c{i % 3}"],) for i in range(60)]
    baskets = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(count), "features array<string>")
    model = mn.fit_fpgrowth(baskets)
    assert {tuple(r["items"]): r["freq"] for r in mn.frequent_itemsets(model, 3).collect()} == {("a", "b", f"c{i}"): 20 for i in range(3)}
    assert mn.association_rules(model).count() > 0
    assert seen.value == len(rows)


def test_policy_model_writes_what_it_fits_on(spark, monkeypatch):
    made, real = [], mn.materialize
    monkeypatch.setattr(mn, "materialize", lambda df, name: (made.append(name), real(df, name))[1])
    rows = [(i % 9, i % 5, "hit" if i % 9 < 4 else "stand", i % 5 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "player_total int, dealer_card int, label_str string, test boolean")
    _, scored = mn.fit_policy_model(df, num_trees=3, depths=(3,), folds=2, test="test", written=True)
    assert scored.count() == 80 and scored.where("label <> prediction").count() == 0
    assert made == ["policy-fit"]


def test_exact_auc_against_pairs(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.4), (0, 0.4), (0, 0.3)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(mn.auc(df).first()["auc"] - brute) < 1e-12


def test_policy_model_auc_bounds(spark):
    """ML-06: seeded forest, hold-out AUC in [0.5, 1] by both measures."""
    from playstream.operators.sequences import to_features
    steps = decision_steps(fx.play_games(spark, SF001), fx.PLAY_HANDS)
    model, scored = mn.fit_policy_model(to_features(steps), num_trees=10)
    from pyspark.ml.functions import vector_to_array
    exact = mn.auc(scored.select("label", F.get(vector_to_array("probability"), 1).alias("score")))
    assert 0.5 <= exact.first()["auc"] <= 1.0
    assert 0.5 <= mn.evaluator_auc(scored) <= 1.0


def test_quantise_assigns_nearest_centroid(spark):
    """ML-09: every row carries the centroid closest to it."""
    from playstream.sources.tables import read_table
    emb = read_table(spark, SF001, "embeddings").select("vec_id", F.slice("embedding", 1, 3).alias("v"))
    q = mn.quantise(emb, "v", k=3, seed=1)
    centres = [r["centroid"] for r in q.select("cluster", "centroid").distinct().collect()]
    for r in q.collect():
        d = [sum((a - b) ** 2 for a, b in zip(r["v"], c)) for c in centres]
        assert sum((a - b) ** 2 for a, b in zip(r["v"], r["centroid"])) <= min(d) + 1e-9
