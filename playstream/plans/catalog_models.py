"""Registered queries: the fitted tree as a table (ML-08), k-means of many
starts (ML-09), and scores of clusters with true distances (EV-12, EV-13).

Their oracles fit the models again in SQL: trees by exhaustive search over
the same thresholds, k-means by the same rounds from the same first points.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import prep
from ..functions.episodes import enrich
from ..operators import kmeans as km
from ..operators import trees as tr
from ..operators.metrics import clustering as cu
from ..operators.mining import assemble
from ..session import materialize
from ..sources import fixtures as fx
from .catalog import episodes_sql
from .catalog_cards import BYTES_SQL, _bytes, _triples
from .catalog_metrics import CLUSTER_SQL, _clusters, sci
from .compare import comparable
from .registry import register

# ------------------------------------------------------------------ ML-08

DEPTH = 4
TREE_FEATURES = ("agent_total", "dealer_card", "n_moves")


def tree_sql(depth: int = DEPTH) -> str:
    """CTEs ``cells`` (finished games by features; rows and wins of the games
    fitted on and of those held out), ``tree`` (the greedy Gini tree of the
    former: best gain, then first feature, then least threshold; a node whose
    children are leaves that predict the same is a leaf), and ``routed``
    (cells with their leaf)."""
    names = ", ".join(TREE_FEATURES)
    gini = "1 - power({y} / {n}, 2) - power(({n} - {y}) / {n}, 2)"
    parts = [f"""{episodes_sql(True)},
ended AS (SELECT l_orderkey % 5 = 0 AS test, result = 'Win' AS win, final_hand[1] AS agent_total, shown_cards[2] AS dealer_card, n_moves FROM r WHERE final_hand[1] IS NOT NULL),
cells AS (SELECT {names}, count(*) FILTER (WHERE NOT test) AS n, count(*) FILTER (WHERE NOT test AND win) AS y,
  count(*) FILTER (WHERE test) AS tn, count(*) FILTER (WHERE test AND win) AS ty FROM ended GROUP BY ALL),
thr AS (""" + " UNION ALL ".join(
        f"SELECT {i} AS fi, '{f}' AS f, t FROM (SELECT (v + lead(v) OVER (ORDER BY v)) / 2.0 AS t FROM (SELECT DISTINCT {f} AS v FROM cells WHERE n > 0)) WHERE t IS NOT NULL"
        for i, f in enumerate(TREE_FEATURES)) + "),\na0 AS (SELECT *, CAST(1 AS BIGINT) AS node FROM cells)"]
    value = "CASE f " + " ".join(f"WHEN '{f}' THEN {f}" for f in TREE_FEATURES) + " END"
    for i in range(depth + 1):
        parts.append(f"s{i} AS (SELECT node, sum(n) AS n, sum(y) AS y FROM a{i} GROUP BY node HAVING sum(n) > 0)")
        if i == depth:
            break
        parts.append(f"""g{i} AS (SELECT node, fi, f, t, sum(a.n) FILTER (WHERE {value} <= t) AS nl, sum(a.y) FILTER (WHERE {value} <= t) AS yl,
  sum(a.n) AS n, sum(a.y) AS y FROM a{i} a, thr GROUP BY node, fi, f, t),
b{i} AS (SELECT * FROM (SELECT *, {gini.format(y='y', n='n')} - nl / n * ({gini.format(y='yl', n='nl')}) - (n - nl) / n * ({gini.format(y='(y - yl)', n='(n - nl)')}) AS gain
    FROM g{i} WHERE nl > 0 AND nl < n) WHERE gain > 1e-12
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, fi, t) = 1),
a{i + 1} AS (SELECT a.* REPLACE (CASE WHEN {value} <= t THEN 2 * a.node ELSE 2 * a.node + 1 END AS node) FROM a{i} a JOIN b{i} b ON a.node = b.node)""")
    parts.append(f"leaf{depth} AS (SELECT node, true AS leaf, y > n - y AS hit FROM s{depth})")
    for i in range(depth - 1, -1, -1):
        parts.append(f"""leaf{i} AS (SELECT s.node, b.node IS NULL OR (l.leaf AND r.leaf AND l.hit = r.hit) AS leaf, s.y > s.n - s.y AS hit
  FROM s{i} s LEFT JOIN b{i} b ON b.node = s.node LEFT JOIN leaf{i + 1} l ON l.node = 2 * s.node LEFT JOIN leaf{i + 1} r ON r.node = 2 * s.node + 1)""")
    parts.append("every AS (" + " UNION ALL ".join(
        f"SELECT s.node, {i} AS depth, s.n, s.y, l.leaf, l.hit, {'b.f, b.t' if i < depth else 'NULL, NULL'} FROM s{i} s JOIN leaf{i} l ON l.node = s.node"
        + (f" LEFT JOIN b{i} b ON b.node = s.node" if i < depth else "") for i in range(depth + 1)) + ")")
    parts.append(f"""tree AS (SELECT * FROM every e WHERE NOT EXISTS (SELECT 1 FROM every u WHERE u.leaf AND u.depth < e.depth AND e.node >> (e.depth - u.depth) = u.node))""")
    parts.append("paths AS (" + " UNION ALL ".join(f"SELECT {names}, node FROM a{i}" for i in range(depth + 1)) + ")")
    parts.append(f"""routed AS (SELECT c.*, t.node, t.hit, t.n AS leaf_n, t.y AS leaf_y FROM cells c
  JOIN paths p USING ({names}) JOIN tree t ON t.node = p.node AND t.leaf)""")
    return ",\n".join(parts)


def _tree(spark, sf_dir):
    """Who wins a finished game, by the agent's total, the dealer's first card
    and the moves; every fifth game is held out."""
    games = enrich(fx.train_games(spark, sf_dir), fx.TRAIN_HANDS).select(
        F.get("final_hand", F.lit(0)).cast("double").alias("agent_total"), F.col("opponent_first_card").cast("double").alias("dealer_card"),
        F.col("n_moves").cast("double").alias("n_moves"), (F.col("result") == "Win").cast("double").alias("label"), (F.col("l_orderkey") % 5 == 0).alias("test"))
    rows = materialize(games.where("agent_total is not null"), "tree-games")
    data = assemble(rows, list(TREE_FEATURES))
    model = DecisionTreeClassifier(maxDepth=DEPTH, labelCol="label", featuresCol="features").fit(data.where("NOT test"))
    return data, model, tr.tree_nodes(spark, model, list(TREE_FEATURES))


@register("ml08_tree_nodes", tree_sql() + f"""
SELECT node, depth, CASE WHEN NOT leaf THEN f END AS feature, CASE WHEN NOT leaf THEN t END AS threshold,
  round(1 - power(y / n, 2) - power((n - y) / n, 2), 6) AS impurity, CAST(n AS BIGINT) AS rows,
  CAST(n - y AS DOUBLE) AS n_other, CAST(y AS DOUBLE) AS n_win, CAST(hit AS DOUBLE) AS prediction FROM tree""")
def q_ml08_nodes(spark, sf_dir):
    """The fitted tree as a table of nodes."""
    _, _, nodes = _tree(spark, sf_dir)
    return comparable(nodes.select("node", "depth", "feature", "threshold", "impurity", "rows",
                                   F.get("counts", F.lit(0)).alias("n_other"), F.get("counts", F.lit(1)).alias("n_win"), "prediction"))


@register("ml08_tree_scores", tree_sql() + """
SELECT test, CAST(agent_total AS DOUBLE) AS agent_total, CAST(dealer_card AS DOUBLE) AS dealer_card, CAST(n_moves AS DOUBLE) AS n_moves, n AS rows, node AS leaf, CAST(hit AS DOUBLE) AS prediction,
  round(leaf_y / leaf_n, 6) AS win_share, n AS as_transform
FROM (SELECT *, false AS test FROM routed UNION ALL SELECT * REPLACE (tn AS n, ty AS y), true AS test FROM routed) WHERE n > 0""")
def q_ml08_scores(spark, sf_dir):
    """Every game scored by the expression made of the node table: leaf,
    prediction and share per cell, and the rows whose ``transform`` by the
    model says the same."""
    data, model, nodes = _tree(spark, sf_dir)
    told, share = tr.score_of(nodes)
    scored = model.transform(data).select(
        "test", *TREE_FEATURES, tr.leaf_of(nodes).cast("long").alias("leaf"), told.alias("told"), F.get(share, F.lit(1)).alias("win_share"), "prediction",
        F.get(vector_to_array("probability"), F.lit(1)).alias("p"))
    same = (F.col("told") == F.col("prediction")) & (F.abs(F.col("win_share") - F.col("p")) < 1e-12)
    return comparable(scored.groupBy("test", *TREE_FEATURES, "leaf", F.col("told").alias("prediction"), "win_share").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("as_transform")))


@register("ml08_tree_precision", tree_sql() + """,
c AS (SELECT test, hit, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS y
  FROM (SELECT false AS test, hit, n, y FROM routed UNION ALL SELECT true, hit, tn, ty FROM routed) GROUP BY test, hit),
t AS (SELECT test, sum(y) AS pos, sum(n) - sum(y) AS neg, sum(n) AS n FROM c GROUP BY test)
SELECT t.test, round((coalesce(pos * (SELECT y / n FROM c WHERE c.test = t.test AND hit), 0) + coalesce(neg * (SELECT (n - y) / n FROM c WHERE c.test = t.test AND NOT hit), 0)) / n, 6) AS precision
FROM t""")
def q_ml08_precision(spark, sf_dir):
    """Weighted precision on the training games and on those held out."""
    data, _, nodes = _tree(spark, sf_dir)
    scored = data.select("test", "label", tr.score_of(nodes)[0].alias("prediction"))
    parts = [tr.weighted_precision(scored.where(F.col("test") == t)).select(F.lit(t).alias("test"), "precision") for t in (False, True)]
    return comparable(parts[0].unionAll(parts[1]))


# ------------------------------------------------------------------ ML-09

K, STARTS, SEED, ROUNDS = 8, 10, 1, 10


def kmeans_sql(rounds: int = ROUNDS) -> str:
    """CTEs ``px`` (pixels of all values), ``pt`` (distinct pixels) and ``fin``
    (per start and cluster: centroid, rows, cost, total cost of the start)."""
    near = """SELECT s, r, g, b, w, min({{'d': (r - cr) * (r - cr) + (g - cg) * (g - cg) + (b - cb) * (b - cb), 'c': c}}) AS m
  FROM pt, c{i} GROUP BY s, r, g, b, w"""
    parts = [f"""WITH {BYTES_SQL},
l AS (SELECT vec_id, list(byte ORDER BY i) AS bl FROM b GROUP BY vec_id),
t AS (SELECT vec_id, bl, len(bl) AS n, unnest(generate_series(0, len(bl) - 1)) AS i FROM l),
px AS (SELECT CAST(bl[i + 1] AS DOUBLE) AS r, CAST(bl[(i + 1) % n + 1] AS DOUBLE) AS g, CAST(bl[(i + 2) % n + 1] AS DOUBLE) AS b FROM t),
pt AS (SELECT r, g, b, count(*) AS w FROM px GROUP BY ALL),
c0 AS (SELECT s, row_number() OVER (PARTITION BY s ORDER BY md5(concat_ws(':', '{SEED}', s, concat_ws(',', printf('%.6f', r), printf('%.6f', g), printf('%.6f', b)))), r, g, b) - 1 AS c, r AS cr, g AS cg, b AS cb
  FROM pt, range({STARTS}) x(s) QUALIFY c < {K})"""]
    for i in range(rounds):
        parts.append(f"""m{i} AS MATERIALIZED ({near.format(i=i)}),
c{i + 1} AS MATERIALIZED (SELECT c{i}.s, c{i}.c, coalesce(a.cr, c{i}.cr) AS cr, coalesce(a.cg, c{i}.cg) AS cg, coalesce(a.cb, c{i}.cb) AS cb
  FROM c{i} LEFT JOIN (SELECT s, m.c AS c, sum(w * r) / sum(w) AS cr, sum(w * g) / sum(w) AS cg, sum(w * b) / sum(w) AS cb FROM m{i} GROUP BY ALL) a ON a.s = c{i}.s AND a.c = c{i}.c)""")
    parts.append(f"""m{rounds} AS MATERIALIZED ({near.format(i=rounds)}),
fin AS (SELECT c{rounds}.*, coalesce(n, 0) AS n, coalesce(cost, 0) AS cost, sum(coalesce(cost, 0)) OVER (PARTITION BY c{rounds}.s) AS total
  FROM c{rounds} LEFT JOIN (SELECT s, m.c AS c, sum(w) AS n, sum(w * m.d) AS cost FROM m{rounds} GROUP BY ALL) a ON a.s = c{rounds}.s AND a.c = c{rounds}.c),
best AS (SELECT s FROM fin GROUP BY s ORDER BY min(total), s LIMIT 1)""")
    return ",\n".join(parts)


def _pixels(spark, sf_dir):
    """Every value of every vector starts a pixel of three bytes."""
    rows = _bytes(spark, sf_dir).groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("i", "byte"))).alias("l"))
    return rows.select(F.inline(_triples(F.col("l.byte")))).select(F.array(*[F.col(c).cast("double") for c in "rgb"]).alias("x"))


def _byte_sql(c: str) -> str:
    return f"CAST(trunc({c}) AS BIGINT)"


@register("ml09_multi_start", kmeans_sql() + f"""
SELECT CAST(s AS INTEGER) AS start, CAST(c AS INTEGER) AS cluster, concat_ws(',', {_byte_sql('cr')}, {_byte_sql('cg')}, {_byte_sql('cb')}) AS bytes,
  round(cr, 6) AS r, round(cg, 6) AS g, round(cb, 6) AS b, CAST(n AS BIGINT) AS n, printf('%.6e', cost) AS cost, s = (SELECT s FROM best) AS kept FROM fin""")
def q_ml09_multi(spark, sf_dir):
    """Ten starts of k-means over all pixels, in ten rounds of one aggregate:
    centroids, as they are and as bytes, rows, cost, and the start kept."""
    found = km.multi_start_kmeans(_pixels(spark, sf_dir), "x", K, STARTS, SEED, max_iter=ROUNDS, tol=0.0)
    out = found.select("start", "cluster", F.array_join(F.transform("centroid", lambda c: c.cast("long")), ",").alias("bytes"),
                       *[F.round(F.get("centroid", F.lit(i)), 6).alias(c) for i, c in enumerate("rgb")], "n", "cost", "kept")
    return sci(out, ["cost"])


def _ev13_sql() -> str:
    gray = " + ".join(f"{{{c}}} * {w}" for c, w in zip("rgb", prep.LUMA))
    return f"""{kmeans_sql()},
kept AS (SELECT {_byte_sql('cr')} AS qr, {_byte_sql('cg')} AS qg, {_byte_sql('cb')} AS qb, c FROM fin WHERE s = (SELECT s FROM best)),
q AS (SELECT {gray.format(r='r', g='g', b='b')} AS x, w, round({gray.format(r='qr', g='qg', b='qb')}, 6) AS k
  FROM m{ROUNDS} m JOIN kept ON kept.c = m.m.c WHERE m.s = (SELECT s FROM best)),
nv AS (SELECT count(DISTINCT v) AS nv FROM (SELECT unnest([qr, qg, qb]) AS v FROM kept JOIN (SELECT DISTINCT m.c AS c FROM m{ROUNDS} m WHERE m.s = (SELECT s FROM best)) u USING (c))),
cent AS (SELECT k, sum(w * x) / sum(w) AS ck, sum(w) AS nk FROM q GROUP BY k),
mean AS (SELECT sum(w * x) / sum(w) AS g, sum(w) AS n FROM q),
sc AS (SELECT k, sum(w * abs(x - ck)) / sum(w) AS s, sum(w * (x - ck) * (x - ck)) AS ss FROM q JOIN cent USING (k) GROUP BY k),
dbr AS (SELECT a.k, max((sa.s + sb.s) / abs(a.ck - b.ck)) AS r FROM cent a JOIN cent b ON a.k <> b.k JOIN sc sa ON sa.k = a.k JOIN sc sb ON sb.k = b.k GROUP BY a.k),
o AS (SELECT (SELECT sum(nk * (ck - g) * (ck - g)) FROM cent, mean) * (n - (SELECT count(*) FROM cent)) / ((SELECT sum(ss) FROM sc) * ((SELECT count(*) FROM cent) - 1)) AS ch,
  (SELECT avg(r) FROM dbr) AS db, nv FROM mean, nv)
SELECT nv AS n_values, printf('%.6e', ch) AS calinski_harabasz, printf('%.6e', db) AS davies_bouldin, printf('%.6e', ch / nv) AS calinski_harabasz_per_value, printf('%.6e', db / nv) AS davies_bouldin_per_value FROM o"""


@register("ev13_kmeans_quality", _ev13_sql())
def q_ev13_kmeans(spark, sf_dir):
    """The pixels quantised to the byte centroids that k-means keeps: internal
    scores of their gray levels against the quantised ones, whole and divided
    by the number of distinct quantised values."""
    px = materialize(_pixels(spark, sf_dir), "pixels")
    found = km.multi_start_kmeans(px, "x", K, STARTS, SEED, max_iter=ROUNDS, tol=0.0).where("kept").orderBy("cluster").collect()  # K rows
    centres = [list(r["centroid"]) for r in found]
    to = F.array(*[F.array(*[F.lit(int(v)) for v in c]) for c in centres])
    moved = px.select("x", F.get(to, km.nearest_centroid(F.col("x"), centres)).alias("q"))

    def gray(v):
        return prep.luminosity(*[F.get(v, F.lit(i)) for i in range(3)])
    q = materialize(moved.select(F.array(gray(F.col("x"))).alias("g"), F.col("q").alias("levels"), F.round(gray(F.col("q")), 6).alias("label")), "quantised")
    n = q.select("levels").distinct().select(F.explode("levels").alias("v")).agg(F.count_distinct("v")).scalar()
    scores = cu.clustering_internal(q, vec="g", labels="label")
    names = ("calinski_harabasz", "davies_bouldin")
    out = scores.select(n.alias("n_values"), "*", *[(F.col(c) / n).alias(f"{c}_per_value") for c in names])
    return sci(out, [c for c in out.columns if c != "n_values"])


# ------------------------------------------------------------------ EV-12

@register("ev12_silhouette_euclidean", f"""{CLUSTER_SQL},
d AS (SELECT x.id, x.k, y.k AS c, sum(list_distance(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[]))) AS d, count(*) AS n
  FROM e x, e y WHERE x.id % 50 = 0 GROUP BY ALL),
p AS (SELECT id, max(CASE WHEN c = k THEN n END) AS own, max(CASE WHEN c = k AND n > 1 THEN d / (n - 1) END) AS a, min(CASE WHEN c <> k THEN d / n END) AS b FROM d GROUP BY id)
SELECT id, round(a, 6) AS a, round(b, 6) AS b, round(CASE WHEN b IS NULL THEN NULL WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS s FROM p""")
def q_ev12_euclidean(spark, sf_dir):
    """Every vector whose id is divisible by 50 against all vectors."""
    return comparable(cu.silhouette_rows(_clusters(spark, sf_dir), F.col("id") % 50 == 0, vec="embedding", labels="label"))
