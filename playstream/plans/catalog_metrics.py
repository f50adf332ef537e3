"""Registered queries: evaluation metrics (EV-01 .. EV-13, SE-01) over
predictions derived from the given tables (FIXTURES.md):

* regression: truth ``l_extendedprice``, prediction ``l_quantity * p_retailprice``;
* multi-class: true vs recognised rank name of every card (line);
* ordinal: absolute difference of the two rank indexes;
* binary: ``labels.quality`` vs ``n_chars >= 1000`` of the document;
* clustering: embeddings, cluster = position of the largest of the first four
  values, truth = the embedding label.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metrics import classification as cl
from ..operators.metrics import clustering as cu
from ..operators.metrics import regression as rg
from ..operators.metrics.registry import metric_row, store_metrics
from ..operators.metrics.registry import register as register_metrics
from ..session import materialize, scratch_path
from ..sources import fixtures as fx
from ..sources.publish import read_published
from ..sources.tables import read_table
from .compare import comparable
from .registry import ORACLES, register


def sci(df, cols=None):
    """Doubles of large magnitude compare in ``%.6e`` form (7 significant
    digits): summation order differs between engines in the last bits."""
    names = cols or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    # Java formatting prints a null as the string "null": keep it null
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.format_string("%.6e", F.col(c)))
                           for c in names})


def _regression(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_extendedprice").alias("y_true"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("y_pred"))


REG_SQL = """WITH d AS (SELECT CAST(l.l_extendedprice AS DOUBLE) AS t,
    CAST(l.l_quantity * p.p_retailprice AS DOUBLE) AS p
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def _e(x: str) -> str:
    return f"printf('%.6e', {x})"


REG_RAW_SQL = f"""{REG_SQL},
m AS (SELECT avg(t) AS mt FROM d),
s AS (SELECT count(*) AS n, avg(abs(p - t)) AS mae, avg((p - t) * (p - t)) AS mse,
    sum((p - t) * (p - t)) AS ss_res, sum((t - mt) * (t - mt)) AS ss_tot,
    avg(abs((t - p) / nullif(t, 0))) * 100 AS mape,
    var_pop(abs(p - t)) AS ev, stddev_pop(abs(p - t)) AS es FROM d, m),
r AS (SELECT *, CASE WHEN ss_tot = 0 THEN (CASE WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END)
                     ELSE 1 - ss_res / ss_tot END AS r2 FROM s)
SELECT n, mae, mse, sqrt(mse) AS rmse, r2, mape, mae AS error_mean, ev AS error_variance,
  es AS error_std, 1 - (1 - r2) * (n - 1) / (n - 2 - 1) AS adjusted_r2 FROM r"""


@register("ev01_regression_metrics", "SELECT n, " + ", ".join(
    f"{_e(c)} AS {c}" for c in ("mae", "mse", "rmse", "r2", "mape", "error_mean", "error_variance",
                                "error_std", "adjusted_r2")) + f" FROM ({REG_RAW_SQL}) x")
def q_ev01(spark, sf_dir):
    return sci(rg.regression_metrics(_regression(spark, sf_dir), n_features=2))


def _bins_sql(legacy: bool) -> str:
    if legacy:
        base, last, cond = "0.0", 4, "d.t > w * (b.bin - 1) AND d.t <= w * b.bin"
    else:
        base, last, cond = ("lo", 5, "(d.t - lo > w * (b.bin - 1) OR b.bin = 1) "
                                     "AND (d.t - lo <= w * b.bin OR b.bin = 5)")
    return f"""{REG_SQL},
rg AS (SELECT min(t) AS lo, (max(t) - min(t)) / 5 AS w FROM d),
b AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, {last + 1}) t(i)),
e AS (SELECT b.bin, abs(d.p - d.t) AS e FROM d, rg, b WHERE {cond})
SELECT bin, {_e(f'{base} + w * (bin - 1)')} AS bin_low, {_e(f'{base} + w * bin')} AS bin_high,
  {_e('avg(e)')} AS mean, {_e('var_pop(e)')} AS variance, {_e('stddev_pop(e)')} AS std_dev,
  {_e('max(e)')} AS max_error, {_e('min(e)')} AS min_error, count(*) AS n_sample
FROM e, rg GROUP BY bin, lo, w"""


@register("ev03_error_distribution_legacy", _bins_sql(True))
def q_ev03(spark, sf_dir):
    return sci(rg.error_distribution(_regression(spark, sf_dir), bins=5, legacy_bins=True))


@register("ev03b_error_distribution_full_range", _bins_sql(False))
def q_ev03b(spark, sf_dir):
    return sci(rg.error_distribution(_regression(spark, sf_dir), bins=5, legacy_bins=False))


def _cards(spark, sf_dir):
    return fx.cards(read_table(spark, sf_dir, "lineitem")).select(
        F.col("category").alias("y_true"), F.col("predicted_category").alias("y_pred"),
        F.abs(F.col("rank_idx") - F.col("pred_idx")).alias("diff"))


PER_CLASS_SQL = f"""WITH {fx.cards_sql()},
cm AS (SELECT y_true, y_pred, count(*) AS cnt FROM named GROUP BY ALL),
cls AS (SELECT y_true AS c FROM cm UNION SELECT y_pred FROM cm),
per AS (SELECT c,
    coalesce((SELECT sum(cnt) FROM cm WHERE cm.y_true = cls.c AND cm.y_pred = cls.c), 0) AS tp,
    coalesce((SELECT sum(cnt) FROM cm WHERE cm.y_pred = cls.c), 0) AS npred,
    coalesce((SELECT sum(cnt) FROM cm WHERE cm.y_true = cls.c), 0) AS support,
    (SELECT sum(cnt) FROM cm) AS n FROM cls),
prf AS (SELECT *, CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS pr,
                  CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS rc FROM per),
f AS (SELECT *, CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END AS f1 FROM prf)"""


def _avg_sql(kind: str) -> str:
    if kind == "weighted":
        m = {k: f"sum({k} * support) / sum(support)" for k in ("pr", "rc", "f1")}
    elif kind == "macro":
        m = {k: f"avg({k})" for k in ("pr", "rc", "f1")}
    else:
        m = {k: "sum(tp) / sum(support)" for k in ("pr", "rc", "f1")}
    return (f"{PER_CLASS_SQL}\nSELECT round(sum(tp) / sum(support), 6) AS accuracy, "
            f"round({m['pr']}, 6) AS precision, round({m['rc']}, 6) AS recall, "
            f"round({m['f1']}, 6) AS f1 FROM f")


for _kind in ("weighted", "macro", "micro"):
    def _q(spark, sf_dir, _k=_kind):
        return comparable(cl.classification_metrics(_cards(spark, sf_dir), average=_k))
    register(f"ev04_classification_{_kind}", _avg_sql(_kind))(_q)


@register("ev05_confusion", f"""WITH {fx.cards_sql()}
SELECT y_true, y_pred, count(*) AS count FROM named GROUP BY ALL""")
def q_ev05(spark, sf_dir):
    return comparable(cl.confusion(_cards(spark, sf_dir)))


def _binary(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        F.col("quality").alias("y_true"), (F.col("n_chars") >= 1000).cast("int").alias("y_pred"))


@register("ev06_hard_auc", """WITH d AS (
  SELECT l.quality AS t, CAST(doc.n_chars >= 1000 AS INTEGER) AS p
  FROM labels l JOIN documents doc ON l.doc_id = doc.doc_id),
c AS (SELECT count(*) FILTER (WHERE t = 1 AND p = 1) AS tp, count(*) FILTER (WHERE t = 1 AND p <> 1) AS fn,
             count(*) FILTER (WHERE t <> 1 AND p = 1) AS fp, count(*) FILTER (WHERE t <> 1 AND p <> 1) AS tn FROM d)
SELECT round(CASE WHEN tp + fn = 0 OR tn + fp = 0 THEN 0.0
            ELSE (tp / (tp + fn) + tn / (tn + fp)) / 2 END, 6) AS roc_auc FROM c""")
def q_ev06(spark, sf_dir):
    return comparable(cl.hard_auc(_binary(spark, sf_dir)))


@register("ev04_classification_binary_weighted", """WITH d AS (
  SELECT CAST(l.quality AS VARCHAR) AS y_true, CAST(CAST(doc.n_chars >= 1000 AS INTEGER) AS VARCHAR) AS y_pred
  FROM labels l JOIN documents doc ON l.doc_id = doc.doc_id),
cls AS (SELECT y_true AS c FROM d UNION SELECT y_pred FROM d),
per AS (SELECT c, (SELECT count(*) FROM d WHERE y_true = c AND y_pred = c) AS tp,
    (SELECT count(*) FROM d WHERE y_pred = c) AS npred, (SELECT count(*) FROM d WHERE y_true = c) AS support FROM cls),
f0 AS (SELECT *, CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS pr,
                 CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS rc FROM per),
f AS (SELECT *, CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END AS f1 FROM f0)
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS precision,
  round(sum(rc * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM f""")
def q_ev04_binary(spark, sf_dir):
    return comparable(cl.classification_metrics(_binary(spark, sf_dir), average="weighted"))


def _r2(x: str) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(38, 12)), 2) AS DOUBLE)"


@register("ev07_per_class_report", f"""{PER_CLASS_SQL},
o AS (SELECT c, tp, npred - tp AS fp, support - tp AS fn, n - npred - support + tp AS tn, n, pr, rc, f1 FROM f),
rows AS (SELECT c AS class, {_r2('pr')} AS precision, {_r2('rc')} AS recall, {_r2('f1')} AS f1_score,
    {_r2('(tp + tn) / n')} AS accuracy,
    CASE WHEN tp + fn = 0 OR tn + fp = 0 THEN NULL ELSE {_r2('(tp / (tp + fn) + tn / (tn + fp)) / 2')} END AS auc_roc
  FROM o)
SELECT class, precision, recall, f1_score, accuracy, auc_roc FROM rows
UNION ALL
SELECT NULL, round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
  round(avg(accuracy), 6), round(avg(auc_roc), 6) FROM rows""")
def q_ev07(spark, sf_dir):
    return comparable(cl.per_class_report(_cards(spark, sf_dir)))


@register("ev08_ordinal_histogram", f"""WITH {fx.cards_sql()}
SELECT abs(rank_idx - pred_idx) AS diff, count(*) AS count FROM cards
WHERE abs(rank_idx - pred_idx) > 0 GROUP BY 1""")
def q_ev08(spark, sf_dir):
    return comparable(cl.ordinal_errors(_cards(spark, sf_dir))[0])


@register("ev08_ordinal_summary", f"""WITH {fx.cards_sql()}, d AS (SELECT abs(rank_idx - pred_idx) AS diff FROM cards)
SELECT round(avg(diff) FILTER (WHERE diff > 0), 6) AS error_mean,
  round(count(*) FILTER (WHERE diff > 0) / count(*) * 100, 6) AS error_rate,
  round(avg(diff), 6) AS overall_mean FROM d""")
def q_ev08s(spark, sf_dir):
    return comparable(cl.ordinal_errors(_cards(spark, sf_dir))[1])


def _clusters(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    head = F.slice("embedding", 1, 4)
    return emb.select(F.col("vec_id").alias("id"), "embedding", F.col("label").alias("truth"),
                      (F.array_position(head, F.array_max(head)) - 1).cast("int").alias("label"))


CLUSTER_SQL = """WITH e AS (SELECT vec_id AS id, embedding, label AS truth,
    CAST(list_position(embedding[1:4], list_max(embedding[1:4])) - 1 AS INTEGER) AS k FROM embeddings)"""


EXT_RAW_SQL = f"""{CLUSTER_SQL},
ct AS (SELECT truth AS c, k, CAST(count(*) AS DOUBLE) AS nij FROM e GROUP BY 1, 2),
a AS (SELECT c, sum(nij) AS ai FROM ct GROUP BY c), b AS (SELECT k, sum(nij) AS bj FROM ct GROUP BY k),
tot AS (SELECT sum(nij) AS n FROM ct),
mi0 AS (SELECT greatest(sum(nij / n * ln(nij * n / (ai * bj))), 0) AS mi
        FROM ct JOIN a USING (c) JOIN b USING (k), tot),
h AS (SELECT (SELECT -sum(ai / n * ln(ai / n)) FROM a) AS hc, (SELECT -sum(bj / n * ln(bj / n)) FROM b) AS hk,
             (SELECT count(*) FROM a) AS nc, (SELECT count(*) FROM b) AS nk FROM tot),
pairs AS (SELECT (SELECT sum(nij * (nij - 1) / 2) FROM ct) AS sij,
                 (SELECT sum(ai * (ai - 1) / 2) FROM a) AS sa, (SELECT sum(bj * (bj - 1) / 2) FROM b) AS sb,
                 n * (n - 1) / 2 AS np FROM tot),
s AS (SELECT *, CASE WHEN hc = 0 THEN 1.0 ELSE mi / hc END AS homog,
                CASE WHEN hk = 0 THEN 1.0 ELSE mi / hk END AS compl FROM mi0, h, pairs)
SELECT CASE WHEN (sa + sb) / 2 = sa * sb / np THEN 1.0
                  ELSE (sij - sa * sb / np) / ((sa + sb) / 2 - sa * sb / np) END AS adjusted_rand,
  CASE WHEN (nc = 1 AND nk = 1) OR (nc = 0 AND nk = 0) THEN 1.0 WHEN mi = 0 THEN 0.0
             ELSE mi / ((hc + hk) / 2) END AS normalized_mutual_info,
  homog AS homogeneity, compl AS completeness,
  CASE WHEN homog + compl = 0 THEN 0.0 ELSE 2 * homog * compl / (homog + compl) END AS v_measure
FROM s"""


@register("ev09_clustering_external", "SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" for c in ("adjusted_rand", "normalized_mutual_info", "homogeneity",
                                      "completeness", "v_measure")) + f" FROM ({EXT_RAW_SQL}) x")
def q_ev09(spark, sf_dir):
    c = _clusters(spark, sf_dir)
    return comparable(cu.clustering_external(c, labels="label", truth="truth"))


@register("ev10_11_clustering_internal", f"""{CLUSTER_SQL},
p AS (SELECT id, k, unnest(generate_series(0, len(embedding) - 1)) AS d,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM e),
cent AS (SELECT k, d, avg(x) AS ck, count(*) AS nk FROM p GROUP BY k, d),
g AS (SELECT d, avg(x) AS gd FROM p GROUP BY d),
nums AS (SELECT (SELECT count(DISTINCT id) FROM p) AS n, (SELECT count(DISTINCT k) FROM cent) AS kk,
  (SELECT sum(nk * (ck - gd) * (ck - gd)) FROM cent JOIN g USING (d)) AS extra,
  (SELECT sum((x - ck) * (x - ck)) FROM p JOIN cent USING (k, d)) AS intra),
dist AS (SELECT id, k, sqrt(sum((x - ck) * (x - ck))) AS dd FROM p JOIN cent USING (k, d) GROUP BY id, k),
s AS (SELECT k, avg(dd) AS s FROM dist GROUP BY k),
m AS (SELECT c1.k, c2.k AS l, sqrt(sum((c1.ck - c2.ck) * (c1.ck - c2.ck))) AS m
      FROM cent c1 JOIN cent c2 ON c1.d = c2.d AND c1.k <> c2.k GROUP BY c1.k, c2.k),
r AS (SELECT m.k, max(CASE WHEN m.m = 0 THEN 0.0 ELSE (s1.s + s2.s) / m.m END) AS r
      FROM m JOIN s s1 ON s1.k = m.k JOIN s s2 ON s2.k = m.l GROUP BY m.k)
SELECT round(CASE WHEN kk < 2 THEN NULL WHEN intra = 0 THEN 1.0
                  ELSE extra * (n - kk) / (intra * (kk - 1)) END, 6) AS calinski_harabasz,
  round(CASE WHEN kk < 2 THEN NULL
             WHEN (SELECT max(s) FROM s) = 0 OR (SELECT max(m) FROM m) = 0 THEN 0.0
             ELSE (SELECT avg(r) FROM r) END, 6) AS davies_bouldin
FROM nums""")
def q_ev10(spark, sf_dir):
    c = _clusters(spark, sf_dir)
    return comparable(cu.clustering_internal(c, vec="embedding", labels="label"))


@register("ev12_silhouette", f"""{CLUSTER_SQL},
p AS (SELECT id, k, unnest(generate_series(0, len(embedding) - 1)) AS d,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM e),
nrm AS (SELECT id, k, sum(x * x) AS xx FROM p GROUP BY id, k),
cs AS (SELECT k, count(*) AS nc, sum(xx) AS psi FROM nrm GROUP BY k),
ys AS (SELECT k, d, sum(x) AS y FROM p GROUP BY k, d),
dots AS (SELECT p.id, ys.k AS c, sum(p.x * ys.y) AS xy FROM p JOIN ys ON p.d = ys.d GROUP BY p.id, ys.k),
dis AS (SELECT n.id, n.k, dots.c, cs.nc,
    (cs.nc * n.xx - 2 * dots.xy + cs.psi) / cs.nc AS avg_sq
  FROM nrm n JOIN dots ON dots.id = n.id JOIN cs ON cs.k = dots.c),
pt AS (SELECT id,
    max(CASE WHEN c = k THEN nc END) AS own_n,
    max(CASE WHEN c = k THEN avg_sq * nc / (nc - 1) END) AS a,
    min(CASE WHEN c <> k THEN avg_sq END) AS b
  FROM dis GROUP BY id),
s AS (SELECT CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END AS si
  FROM pt)
SELECT round(avg(si), 6) AS silhouette FROM s""")
def q_ev12(spark, sf_dir):
    """Spark's squared-Euclidean silhouette of the clusters; the oracle
    computes it from per-cluster sums (points x clusters, no point pairs)."""
    return comparable(cu.silhouette(_clusters(spark, sf_dir), vec="embedding", labels="label"))


def _reg_sql(stored: bool = False) -> str:
    """Three registry rows: the regression, classification and clustering
    statements above, each value rounded to 4 places, missing columns null.
    ``stored``: what is left of two runs, with the run of each row."""
    reg_cols = ["mae", "mse", "rmse", "r2", "mape", "error_mean", "error_variance",
                "error_std", "adjusted_r2"]
    cls_cols = ["accuracy", "precision", "recall", "f1"]
    ext_cols = ["adjusted_rand", "normalized_mutual_info", "homogeneity", "completeness", "v_measure",
                "calinski_harabasz", "davies_bouldin", "silhouette"]
    allc = reg_cols + cls_cols + ext_cols

    def row(name, src, cols, n):
        vals = ", ".join(
            (f"printf('%.6e', round(CAST({c} AS DOUBLE), 4)) AS {c}" if c in cols
             else f"CAST(NULL AS VARCHAR) AS {c}") for c in allc)
        return f"SELECT '{name}' AS algorithm, CAST({n} AS DOUBLE) AS n, {vals} FROM ({src}) x"

    reg = REG_RAW_SQL
    cls = _avg_sql("weighted").replace("round(", "(").replace(", 6)", ")")
    if stored:
        macro = _avg_sql("macro").replace("round(", "(").replace(", 6)", ")")
        rows = [row("price_from_quantity", reg, reg_cols, "n"), row("card_recogniser", macro, cls_cols, "CAST(NULL AS BIGINT)"),
                row("argmax_head", EXT_RAW_SQL, ext_cols[:5], "CAST(NULL AS BIGINT)")]
        return " UNION ALL ".join(r.replace("SELECT", f"SELECT CAST({run} AS BIGINT) AS run,", 1) for r, run in zip(rows, (1, 2, 2)))
    ext = (f"SELECT * FROM ({EXT_RAW_SQL}), ({ORACLES['ev10_11_clustering_internal']}), "
           f"({ORACLES['ev12_silhouette']})")
    return " UNION ALL ".join([
        row("price_from_quantity", reg, reg_cols, "n"),
        row("card_recogniser", cls, cls_cols, "CAST(NULL AS BIGINT)"),
        row("argmax_head", ext, ext_cols, "CAST(NULL AS BIGINT)")])


@register("se01_metric_registry", _reg_sql())
def q_se01(spark, sf_dir):
    """Regression, classification and clustering rows in one registry table
    (4 decimals, missing columns null)."""
    reg = register_metrics(None, "price_from_quantity",
                           rg.regression_metrics(_regression(spark, sf_dir), n_features=2))
    reg = register_metrics(reg, "card_recogniser", cl.classification_metrics(_cards(spark, sf_dir)))
    c = _clusters(spark, sf_dir)
    reg = register_metrics(reg, "argmax_head", cu.clustering_report(c, vec="embedding", labels="label", truth="truth"))
    return sci(reg.withColumn("n", F.col("n").cast("double")), [
        f.name for f in reg.schema.fields if f.dataType.typeName() == "double"])


@register("se01_stored_registry", _reg_sql(stored=True))
def q_se01_stored(spark, sf_dir):
    """The registry as a stored table: a run of two rows, a second run that
    replaces one and adds one, the second run once more, and a row of the
    first run that comes late."""
    dst = scratch_path(spark, "registry")
    reg = metric_row("price_from_quantity", rg.regression_metrics(_regression(spark, sf_dir), n_features=2))
    first = register_metrics(reg, "card_recogniser", cl.classification_metrics(_cards(spark, sf_dir)))
    second = register_metrics(metric_row("card_recogniser", cl.classification_metrics(_cards(spark, sf_dir), average="macro")),
                              "argmax_head", cu.clustering_external(_clusters(spark, sf_dir), labels="label", truth="truth"))
    second = materialize(second, "run-2")
    for rows, run in ((first, 1), (second, 2), (second, 2), (first.where("algorithm = 'card_recogniser'"), 1)):
        store_metrics(rows, dst, run)
    out = read_published(spark, dst)
    missing = [c for c in ("calinski_harabasz", "davies_bouldin", "silhouette") if c not in out.columns]
    out = out.withColumns({c: F.lit(None).cast("double") for c in missing}).withColumn("n", F.col("n").cast("double"))
    return sci(out, [f.name for f in out.schema.fields if f.dataType.typeName() == "double" and f.name != "n"])
