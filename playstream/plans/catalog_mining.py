"""Registered queries: decision steps, mining, models (ML-01 .. ML-09)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.prep import expert_columns
from ..operators import mining as mn
from ..operators import trees as tr
from ..session import materialize
from ..operators.sequences import decision_steps, to_basket, to_features
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .compare import comparable
from .registry import register

STEP_TABLES = ("st_u", "st_v", "st_w", "st_x")


def steps_sql() -> str:
    """CTEs ending in ``steps`` (decision steps of the play games), defined
    relationally: hands unnested with their position, the valid prefix ends
    at the first missing hand, a step hits when the next hand's agent total
    is different, and a game's steps end at its first stand."""
    n = fx.PLAY_HANDS
    hands = ", ".join(["shown_cards"] + [f"hand_{k}" for k in range(n)])
    return f"""WITH {fx.play_games_sql()},
st_u AS (SELECT l_orderkey, shown_cards[2] AS dealer_card, k,
    ([{hands}])[k + 1] AS h, ([{hands}])[k + 2] AS nxt
  FROM games CROSS JOIN range(0, {n + 1}) t(k)),
st_v AS (SELECT *, min(CASE WHEN h IS NULL THEN k END) OVER (PARTITION BY l_orderkey) AS first_null FROM st_u),
st_w AS (SELECT l_orderkey, dealer_card, k, h[1] AS player_total,
    CASE WHEN k + 1 < coalesce(first_null, {n + 1}) AND nxt[1] IS DISTINCT FROM h[1]
         THEN 'hit' ELSE 'stand' END AS action
  FROM st_v WHERE k < coalesce(first_null, {n + 1})),
st_x AS (SELECT *, min(CASE WHEN action = 'stand' THEN k END) OVER (PARTITION BY l_orderkey) AS first_stand FROM st_w),
steps AS (SELECT l_orderkey, CAST(k AS INTEGER) AS step, player_total, dealer_card, action
  FROM st_x WHERE k <= first_stand)"""


def itemsets_sql() -> str:
    """Every non-empty subset of each 3-item basket, counted; frequent when
    the count reaches ceil(minSupport * baskets) (double arithmetic)."""
    return f"""{steps_sql()},
b AS (SELECT 'player_' || coalesce(CAST(player_total AS VARCHAR), 'None') AS p,
             'dealer_' || coalesce(CAST(dealer_card AS VARCHAR), 'None') AS d, action AS a FROM steps),
nb AS (SELECT count(*) AS n FROM b),
sub AS (SELECT [p] AS s FROM b UNION ALL SELECT [d] FROM b UNION ALL SELECT [a] FROM b
  UNION ALL SELECT [p, d] FROM b UNION ALL SELECT [p, a] FROM b UNION ALL SELECT [d, a] FROM b
  UNION ALL SELECT [p, d, a] FROM b),
f AS (SELECT list_sort(s) AS items, count(*) AS freq FROM sub GROUP BY 1
  HAVING count(*) >= ceil(CAST({mn.MIN_SUPPORT} AS DOUBLE) * (SELECT n FROM nb)))"""


def _play_steps(spark, sf_dir):
    return decision_steps(fx.play_games(spark, sf_dir), fx.PLAY_HANDS)


@register("ml01_decision_steps", steps_sql() + "\nSELECT * FROM steps")
def q_ml01(spark, sf_dir):
    return comparable(_play_steps(spark, sf_dir))


def _fp_model(spark, sf_dir):
    return mn.fit_fpgrowth(to_basket(_play_steps(spark, sf_dir)))


@register("ml02_frequent_itemsets", itemsets_sql() + """
SELECT array_to_string(items, ',') AS items, freq FROM f WHERE len(items) >= 2""")
def q_ml02(spark, sf_dir):
    return comparable(mn.frequent_itemsets(_fp_model(spark, sf_dir)))


@register("ml03_association_rules", itemsets_sql() + f""",
cand AS (SELECT items, freq, unnest(items) AS c FROM f WHERE len(items) >= 2),
rl AS (SELECT list_filter(items, lambda i: i <> c) AS antecedent, [c] AS consequent, freq AS fx FROM cand)
SELECT array_to_string(rl.antecedent, ',') AS antecedent, array_to_string(rl.consequent, ',') AS consequent,
  round(fx / a.freq, 6) AS confidence,
  round((fx / a.freq) / (cf.freq / (SELECT n FROM nb)), 6) AS lift,
  round(fx / (SELECT n FROM nb), 6) AS support
FROM rl JOIN f a ON a.items = rl.antecedent JOIN f cf ON cf.items = rl.consequent
WHERE fx / a.freq >= {mn.MIN_CONFIDENCE}""")
def q_ml03(spark, sf_dir):
    return comparable(mn.association_rules(_fp_model(spark, sf_dir)))


@register("ml04_label_index", steps_sql() + """
SELECT action AS label_str,
  CAST(row_number() OVER (ORDER BY count(*) DESC, action) - 1 AS DOUBLE) AS label,
  count(*) AS count
FROM steps GROUP BY action""")
def q_ml04(spark, sf_dir):
    # fitting the indexer and applying it both read the steps: written once
    feats = materialize(to_features(_play_steps(spark, sf_dir)), "features")
    idx = mn.index_labels(feats)
    return comparable(idx.groupBy("label_str", "label").agg(F.count(F.lit(1)).alias("count")))


@register("ml06_policy_model", steps_sql() + """,
c AS (SELECT player_total, dealer_card, count(*) FILTER (WHERE l_orderkey % 5 <> 0) AS train_rows,
  count(*) FILTER (WHERE l_orderkey % 5 = 0) AS test_rows, count(*) FILTER (WHERE l_orderkey % 5 = 0 AND action = 'hit') AS test_hits FROM steps GROUP BY ALL),
a AS (SELECT player_total, mode(action) AS act FROM steps WHERE l_orderkey % 5 <> 0 GROUP BY ALL),
told AS (SELECT sum(test_hits) AS p, sum(test_rows - test_hits) AS n,
  sum(CASE WHEN act = 'hit' THEN test_hits ELSE 0 END) AS tp, sum(CASE WHEN act = 'hit' THEN test_rows - test_hits ELSE 0 END) AS fp FROM c JOIN a USING (player_total))
SELECT player_total, dealer_card, test_rows, test_hits, a.act AS action, round(tp / p, 6) AS hit_recall, round(1 - fp / n, 6) AS stand_recall, true AS auc_fits
FROM c JOIN a USING (player_total), told WHERE test_rows > 0""")
def q_ml06(spark, sf_dir):
    """Cross-validated forest, held out by game: per cell of the held-out steps
    their rows, hits and the fitted action, and the forest's recall of either
    action on them; whether its exact AUC is no worse than that of its own
    actions and the evaluator agrees. The oracle acts as most training steps
    of the same total do, which is the rule that these games follow."""
    feats = materialize(to_features(_play_steps(spark, sf_dir), keep=("l_orderkey",))
                        .withColumn("test", F.col("l_orderkey") % 5 == 0), "policy-steps")
    _, scored = mn.fit_policy_model(feats, test="test", written=True)
    scored = scored.withColumns({"f": vector_to_array("features"), "score": F.get(vector_to_array("probability"), F.lit(1))})
    told = materialize(scored.select(F.get("f", F.lit(0)).cast("int").alias("player_total"), F.get("f", F.lit(1)).cast("int").alias("dealer_card"),
                                     "label", "prediction", "score", "rawPrediction"), "policy-scored")
    # the index of an action follows its frequency
    hit = feats.groupBy("label_str").count().orderBy(F.desc("count"), "label_str").first()["label_str"] != "hit"
    is_hit, says_hit = F.col("label") == int(hit), F.col("prediction") == int(hit)
    exact, agrees = mn.auc(told).first()["auc"], mn.evaluator_auc(told)
    cells = told.groupBy("player_total", "dealer_card").agg(
        F.count(F.lit(1)).alias("test_rows"), F.count_if(is_hit).alias("test_hits"), F.count_if(is_hit & says_hit).alias("tp"),
        F.count_if(~is_hit & says_hit).alias("fp"), F.when(F.max("prediction") == int(hit), "hit").otherwise("stand").alias("action"))
    cells = materialize(cells, "policy-cells")
    sums = cells.agg(F.sum("tp") / F.sum("test_hits"), 1 - F.sum("fp") / F.sum(F.col("test_rows") - F.col("test_hits"))).first()
    fits = exact >= sum(sums) / 2 - 1e-9 and abs(exact - agrees) < 0.02
    return comparable(cells.drop("tp", "fp").select("*", F.lit(sums[0]).alias("hit_recall"), F.lit(sums[1]).alias("stand_recall"), F.lit(fits).alias("auc_fits")))


def _doc_scores(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("score"))
    return labels.join(docs, "doc_id")


@register("ml07_auc_quality_by_length", """
WITH d AS (SELECT l.quality AS label, doc.n_chars AS score
           FROM labels l JOIN documents doc ON l.doc_id = doc.doc_id
           WHERE doc.n_chars IS NOT NULL AND l.quality IN (0, 1)),
s AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
      FROM d GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM s)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
def q_ml07(spark, sf_dir):
    return comparable(mn.auc(_doc_scores(spark, sf_dir)))


EXPERTS, OUTPUTS = 32, 2


@register("ml08_surrogate_tree", """WITH t AS (SELECT vec_id % 5 = 0 AS test, label FROM embeddings)
SELECT test, CAST(label AS DOUBLE) AS label, count(*) AS count, count(*) AS as_transform, true AS fits_training FROM t GROUP BY ALL""")
def q_ml08(spark, sf_dir):
    """Tree over the 64 embedding values read as 32 experts x 2 outputs,
    predicting the embedding label; a fifth of the vectors held out: rows per
    split and label, those that the expression made of its nodes scores as the
    model does, and whether it is right on its own rows more often than one
    label for all would be (labels here follow no rule that held-out rows
    share). Trees that do generalise are refitted in SQL by ``ml08_tree_*``."""
    emb = read_table(spark, sf_dir, "embeddings")
    wide = materialize(emb.select("vec_id", F.col("label").cast("double").alias("label"),
                                  *expert_columns("embedding", EXPERTS, OUTPUTS)), "experts")
    held = F.col("vec_id") % 5 == 0
    model = mn.fit_surrogate_tree(wide.where(~held), [c for c in wide.columns if c.startswith("expert_")])
    features = [c for c in wide.columns if c.startswith("expert_")]
    told, _ = tr.score_of(tr.tree_nodes(spark, model.bestModel.stages[-1], features))
    scored = materialize(model.transform(wide).select(held.alias("test"), "label", "prediction", told.alias("told")), "tree-scored")
    own = scored.where("NOT test")
    right = own.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
    share = own.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    return scored.groupBy("test", "label").agg(F.count(F.lit(1)).alias("count"), F.count_if(F.col("prediction") == F.col("told")).alias("as_transform")).withColumn(
        "fits_training", F.lit(right > share))


@register("ml09_quantise", """SELECT count(*) AS count, CAST(10 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced
FROM embeddings""")
def q_ml09(spark, sf_dir):
    """k-means (k = 10, best of ten starts) over the embeddings: rows, clusters
    in use, and rows that have a nearer centroid than their own. Starts, costs
    and centroids are compared by ``ml09_multi_start``."""
    emb = read_table(spark, sf_dir, "embeddings")
    q = materialize(mn.quantise(emb.select("vec_id", F.col("embedding").cast("array<double>").alias("x")), "x", k=10), "quantised")
    found = q.select("cluster", "centroid").distinct().collect()  # k rows
    centres = F.array(*[F.array(*map(F.lit, r["centroid"])) for r in found])

    def far(c):
        return F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
    nearest = F.array_min(F.transform(centres, far))
    return q.agg(F.count(F.lit(1)).alias("count"), F.count_distinct("cluster").alias("clusters"),
                 F.count_if(far(F.col("centroid")) > nearest + 1e-9).alias("misplaced"))
