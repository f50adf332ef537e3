"""Registered queries: card scoring and policy (AG-11 .. AG-14, JN-02,
JN-03), table preparation (PR-16 .. PR-23), IO jobs (IO-02 .. IO-04, IO-09,
IO-10) and quantisation quality (EV-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prep
from ..operators import cards as cd
from ..operators.index import with_index
from ..operators.metrics import clustering as cu
from ..session import materialize, scratch_path
from ..sources import fixtures as fx
from ..sources import sinks
from ..sources.publish import read_published
from ..sources.tables import TABLES, load_result, read_table
from . import reports as rp
from .catalog import RP01_SQL, episodes_sql
from .compare import comparable, nullable_ints_as_double
from .registry import register


def _names(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _bonus_sql(col: str) -> str:
    return ("CASE " + col + " " + " ".join(f"WHEN '{s}' THEN {b}" for s, b in cd.SUIT_BONUS.items())
            + " ELSE 0 END")


CARD_SQL = f"""c0 AS (
  SELECT l_orderkey AS hand_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(fx.LINE_ORDER)}) AS pos,
    CAST(l_partkey % 13 AS INTEGER) AS r,
    CAST((l_partkey % 13 + CASE WHEN CAST(floor(l_quantity) AS INTEGER) % 10 = 0 THEN 1 ELSE 0 END) % 13 AS INTEGER) AS pr,
    ({_names(fx.SUITS)})[l_suppkey % 4 + 1] AS suit, l_linenumber % 2 = 1 AS mine
  FROM lineitem),
c AS (SELECT hand_id, pos, mine, suit, suit AS predicted_suit, ({_names(fx.RANK_VALUES)})[r + 1] AS value,
    ({_names(fx.RANK_NAMES)})[r + 1] AS category, ({_names(fx.RANK_NAMES)})[pr + 1] AS predicted_category
  FROM c0),
cp AS (SELECT *,
    CASE WHEN value IN ('J', 'Q', 'K') THEN 10 WHEN value = 'A' THEN 11 ELSE TRY_CAST(value AS INTEGER) END
      + {_bonus_sql('suit')} AS pts,
    CASE WHEN predicted_category IN {tuple(cd.FACE_NAMES)} THEN 10 WHEN predicted_category = 'ace' THEN 11
         WHEN predicted_category IN {tuple(cd.NUMBER_NAMES)} THEN TRY_CAST(value AS INTEGER) END AS vb
  FROM c),
cv AS (SELECT *, CASE WHEN vb + {_bonus_sql('predicted_suit')} > 21 AND value = 'A'
                      THEN vb + {_bonus_sql('predicted_suit')} - 10
                      ELSE vb + {_bonus_sql('predicted_suit')} END AS visible_value,
              vb IS NULL AS rejected FROM cp)"""

HANDS_SQL = f"""WITH {CARD_SQL},
h AS (SELECT hand_id, CAST(sum(pts) AS INTEGER) AS raw_total,
    CAST(count(*) FILTER (WHERE value = 'A') AS INTEGER) AS aces FROM cv GROUP BY hand_id),
hd AS (SELECT *, coalesce(list_min(list_filter(range(0, aces + 1), lambda i: raw_total - 10 * i <= 21)), aces) AS dm
  FROM h),
hs AS (SELECT hand_id, raw_total, aces, CAST(raw_total - 10 * dm AS INTEGER) AS score,
    CAST(aces - dm AS INTEGER) AS usable_aces FROM hd),
st AS (SELECT hs.hand_id, score AS player_total, v.visible_value AS dealer_visible_card,
    usable_aces AS usable_ace, v.category = v.predicted_category AS clean
  FROM hs JOIN cv v ON v.hand_id = hs.hand_id AND v.pos = 1),
rs AS (SELECT *, CASE
    WHEN player_total IS NULL OR player_total NOT BETWEEN {cd.TOTAL_RANGE[0]} AND {cd.TOTAL_RANGE[1]} THEN 'player_total out of range'
    WHEN dealer_visible_card IS NULL OR dealer_visible_card NOT BETWEEN {cd.VISIBLE_RANGE[0]} AND {cd.VISIBLE_RANGE[1]} THEN 'dealer_visible_card out of range'
    WHEN usable_ace IS NULL OR usable_ace NOT IN (0, 1, 2) THEN 'usable_ace out of range' END AS reason FROM st)"""


def _cards(spark, sf_dir):
    return cd.visible_value(fx.cards(read_table(spark, sf_dir, "lineitem")))


def _states(spark, sf_dir):
    """One row per hand (narrow), written once: the policy table and the
    lookup both read it instead of deriving the cards twice."""
    first = F.min_by(F.struct("visible_value", (F.col("category") == F.col("predicted_category")).alias("clean")),
                     F.struct(*fx.LINE_ORDER))
    scored = cd.score_hands(_cards(spark, sf_dir), extra=[first.alias("first")])
    return materialize(
        scored.select("hand_id", F.col("score").alias("player_total"),
                      F.col("first.visible_value").alias("dealer_visible_card"),
                      F.col("usable_aces").alias("usable_ace"), "first.clean"), "states")


@register("ag11_hand_scores", HANDS_SQL + "\nSELECT * FROM hs")
def q_ag11(spark, sf_dir):
    return comparable(cd.score_hands(_cards(spark, sf_dir)))


@register("ag13_visible_values", f"""WITH {CARD_SQL}
SELECT hand_id, value, predicted_category, predicted_suit, CAST(visible_value AS DOUBLE) AS visible_value,
  rejected FROM cv""")
def q_ag13(spark, sf_dir):
    c = _cards(spark, sf_dir)
    return comparable(nullable_ints_as_double(
        c.select("hand_id", "value", "predicted_category", "predicted_suit", "visible_value", "rejected"),
        ["visible_value"]))


@register("ag14_settlement", f"""WITH {CARD_SQL},
g AS (SELECT hand_id,
    CAST(sum(CASE WHEN mine THEN pts ELSE 0 END) AS INTEGER) AS p_raw,
    CAST(count(*) FILTER (WHERE mine AND value = 'A') AS INTEGER) AS p_aces,
    CAST(sum(CASE WHEN NOT mine THEN pts ELSE 0 END) AS INTEGER) AS d_raw,
    CAST(count(*) FILTER (WHERE NOT mine AND value = 'A') AS INTEGER) AS d_aces
  FROM cv GROUP BY hand_id),
s AS (SELECT hand_id,
    p_raw - 10 * coalesce(list_min(list_filter(range(0, p_aces + 1), lambda i: p_raw - 10 * i <= 21)), p_aces) AS ps,
    d_raw - 10 * coalesce(list_min(list_filter(range(0, d_aces + 1), lambda i: d_raw - 10 * i <= 21)), d_aces) AS ds
  FROM g)
SELECT CASE WHEN ps > 21 THEN 'Lose' WHEN ds > 21 THEN 'Win' WHEN ps > ds THEN 'Win'
            WHEN ps < ds THEN 'Lose' ELSE 'Draw' END AS outcome, count(*) AS count
FROM s GROUP BY 1""")
def q_ag14(spark, sf_dir):
    """All cards of an order: odd lines are the player's, even ones the dealer's."""
    hands = cd.score_two_hands(fx.cards(read_table(spark, sf_dir, "lineitem")), F.col("l_linenumber") % 2 == 1)
    return comparable(hands.groupBy("outcome").agg(F.count(F.lit(1)).alias("count")))


@register("jn03_state_rejects", HANDS_SQL + """
SELECT hand_id, player_total, CAST(dealer_visible_card AS DOUBLE) AS dealer_visible_card, usable_ace, reason
FROM rs WHERE reason IS NOT NULL""")
def q_jn03(spark, sf_dir):
    _, rejects = cd.split_valid_states(_states(spark, sf_dir))
    return comparable(nullable_ints_as_double(rejects.drop("clean"), ["dealer_visible_card"]))


def _q_table(valid_states):
    """Action values learned from the states whose visible card was read
    correctly (so states behind misread cards may have no entry)."""
    return (valid_states.filter(F.col("clean"))
            .groupBy(*cd.STATE_KEYS)
            .agg(F.avg(F.col("hand_id") % 7).alias("q_stand"),
                 F.avg(F.col("hand_id") % 6).alias("q_hit")))


@register("jn02_policy_actions", HANDS_SQL + """,
ok AS (SELECT * FROM rs WHERE reason IS NULL),
q AS (SELECT player_total, dealer_visible_card, usable_ace, avg(hand_id % 7) AS q_stand, avg(hand_id % 6) AS q_hit
  FROM ok WHERE clean GROUP BY ALL)
SELECT ok.hand_id, ok.player_total, ok.dealer_visible_card, ok.usable_ace,
  CASE WHEN coalesce(q.q_hit, 0) > coalesce(q.q_stand, 0) THEN 1 ELSE 0 END AS action
FROM ok LEFT JOIN q USING (player_total, dealer_visible_card, usable_ace)""")
def q_jn02(spark, sf_dir):
    valid, _ = cd.split_valid_states(_states(spark, sf_dir))
    acted = cd.apply_policy(valid, _q_table(valid))
    return comparable(acted.drop("clean"))


# -------------------------------------------------------------- preparation

MANIFEST_ROOT = "/data/cards"


def manifest_table(spark, sf_dir):
    """An image manifest derived from ``part`` (FIXTURES.md)."""
    part = read_table(spark, sf_dir, "part")
    name = F.element_at(F.array(*[F.lit(v) for v in fx.RANK_NAMES]), (F.col("p_partkey") % 13 + 1).cast("int"))
    suit = F.element_at(F.array(*[F.lit(v) for v in fx.SUITS]), (F.col("p_size") % 4 + 1).cast("int"))
    split = (F.when(F.col("p_partkey") % 10 == 0, "test")
              .when(F.col("p_partkey") % 10 == 1, "valid").otherwise("train"))
    return part.select(
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("filepaths"),
        F.when(F.col("p_partkey") % 53 == 0, F.lit("joker"))
         .otherwise(F.concat(name, F.lit(" of "), suit)).alias("labels"),
        name.alias("card type"), split.alias("data set"))


MANIFEST_SQL = f"""WITH m AS (
  SELECT 'part/' || p_partkey || '.jpg' AS filepaths,
    CASE WHEN p_partkey % 53 = 0 THEN 'joker'
         ELSE ({_names(fx.RANK_NAMES)})[p_partkey % 13 + 1] || ' of ' || ({_names(fx.SUITS)})[p_size % 4 + 1] END AS labels,
    ({_names(fx.RANK_NAMES)})[p_partkey % 13 + 1] AS card_type,
    CASE p_partkey % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'valid' ELSE 'train' END AS data_set
  FROM part),
t AS (SELECT filepaths, labels, string_split(labels, ' ')[-1] AS suit, card_type AS category,
    '{MANIFEST_ROOT}/' || filepaths AS filepaths_full, data_set AS split
  FROM m WHERE lower(labels) <> 'joker')"""

def _prepared(spark, sf_dir):
    """IO-04 round trip: the manifest written as CSV with a header, read back
    with a declared schema, then PR-16 preparation of all splits in one scan."""
    path = scratch_path(spark, "manifest")
    manifest_table(spark, sf_dir).write.csv(path, header=True)
    raw = sinks.read_manifest(spark, path)
    return prep.prepare_manifest(raw, None, MANIFEST_ROOT)


@register("pr16_prepare_manifest", MANIFEST_SQL + "\nSELECT * FROM t")
def q_pr16(spark, sf_dir):
    return comparable(_prepared(spark, sf_dir))


@register("pr17_one_hot", MANIFEST_SQL + "\nSELECT filepaths, split, " + ", ".join(
    f"CAST(category = '{v}' AS INTEGER) AS {v}" for v in prep.CATEGORY_ORDER) + " FROM t")
def q_pr17(spark, sf_dir):
    oh = prep.one_hot(_prepared(spark, sf_dir), "category", list(prep.CATEGORY_ORDER))
    return comparable(oh.select("filepaths", "split", *prep.CATEGORY_ORDER))


@register("pr18_shuffle", MANIFEST_SQL + """
SELECT *, row_number() OVER (ORDER BY md5(filepaths || '55'), filepaths) - 1 AS position FROM t""")
def q_pr18(spark, sf_dir):
    """Seeded permutation of the whole prepared manifest, with positions."""
    return comparable(prep.shuffle(_prepared(spark, sf_dir), "filepaths", seed=55))


EMB = "embeddings"


#: One label per embedding value: the categories, again and again.
LABELS = [f"{prep.CATEGORY_ORDER[i % 13]}_{i // 13}" for i in range(64)]


@register("pr19_argmax_label", f"""SELECT vec_id,
  ({_names(LABELS)})[list_position(embedding, list_max(embedding))] AS predicted
FROM embeddings""")
def q_pr19(spark, sf_dir):
    e = read_table(spark, sf_dir, EMB)
    return comparable(e.select("vec_id", prep.argmax_label(F.col("embedding"), LABELS).alias("predicted")))


EXPERTS, OUTPUTS = 32, 2
# The pruned experts of the reference's category model.
PRUNED_EXPERTS = [1, 3, 8, 9, 12, 16, 21]


def _expert_sql(pruned: list[int]) -> str:
    cols = []
    for e in range(EXPERTS):
        for o in range(OUTPUTS):
            v = "CAST(0.0 AS DOUBLE)" if e in pruned else f"CAST(embedding[{e * OUTPUTS + o + 1}] AS DOUBLE)"
            cols.append(f"round({v}, 6) AS expert_{e}_{o}")
    return "SELECT vec_id, " + ", ".join(cols) + " FROM embeddings"


@register("pr20_expert_columns", _expert_sql([]))
def q_pr20(spark, sf_dir):
    e = read_table(spark, sf_dir, EMB)
    return comparable(e.select("vec_id", *prep.expert_columns("embedding", EXPERTS, OUTPUTS)))


@register("pr21_prune_slots", _expert_sql(PRUNED_EXPERTS))
def q_pr21(spark, sf_dir):
    e = prep.prune_slots(read_table(spark, sf_dir, EMB), "embedding", PRUNED_EXPERTS, OUTPUTS)
    return comparable(e.select("vec_id", *prep.expert_columns("embedding", EXPERTS, OUTPUTS)))


# every value of every vector as a byte of the whole table's range
BYTES_SQL = """x AS (SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS i,
  CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT vec_id, i, CAST(trunc((v - lo) / (hi - lo) * 255.0) AS INTEGER) AS byte FROM x, r)"""


def _bytes(spark, sf_dir):
    e = read_table(spark, sf_dir, EMB).select("vec_id", F.posexplode("embedding").alias("i", "v"))
    return prep.rescale_byte(e, "v").select("vec_id", "i", "byte")


@register("pr22_rescale_byte", f"WITH {BYTES_SQL} SELECT vec_id, i, byte FROM b")
def q_pr22(spark, sf_dir):
    return comparable(_bytes(spark, sf_dir).withColumn("i", F.col("i").cast("long")))


def _triples(values):
    """Each value of an array with the two after it, around its end, as a pixel."""
    n = F.size(values)
    return F.transform(values, lambda x, i: F.struct(
        i.alias("i"), x.alias("r"), F.get(values, (i + 1) % n).alias("g"), F.get(values, (i + 2) % n).alias("b")))


@register("pr23_luminosity", f"""WITH l AS (SELECT vec_id, embedding AS e, len(embedding) AS n,
  unnest(generate_series(0, len(embedding) - 1)) AS i FROM embeddings)
SELECT vec_id, i, round(CAST(e[i + 1] AS DOUBLE) * {prep.LUMA[0]} + CAST(e[(i + 1) % n + 1] AS DOUBLE) * {prep.LUMA[1]}
  + CAST(e[(i + 2) % n + 1] AS DOUBLE) * {prep.LUMA[2]}, 6) AS gray FROM l""")
def q_pr23(spark, sf_dir):
    """Every value starts a pixel of three."""
    e = read_table(spark, sf_dir, EMB).withColumn("e", F.col("embedding").cast("array<double>"))
    px = e.select("vec_id", F.inline(_triples(F.col("e"))))
    return comparable(px.select("vec_id", F.col("i").cast("long").alias("i"), prep.luminosity("r", "g", "b").alias("gray")))


LEVEL = 64


@register("ev13_quantise_quality", f"""WITH {BYTES_SQL},
l AS (SELECT vec_id, list(byte ORDER BY i) AS bl FROM b GROUP BY vec_id),
t AS (SELECT vec_id, bl, len(bl) AS n, unnest(generate_series(0, len(bl) - 1)) AS i FROM l),
px AS (SELECT bl[i + 1] AS r, bl[(i + 1) % n + 1] AS g, bl[(i + 2) % n + 1] AS bb FROM t),
q AS (SELECT r * {prep.LUMA[0]} + g * {prep.LUMA[1]} + bb * {prep.LUMA[2]} AS x,
  r // {LEVEL} * {LEVEL} + {LEVEL // 2} AS qr, g // {LEVEL} * {LEVEL} + {LEVEL // 2} AS qg, bb // {LEVEL} * {LEVEL} + {LEVEL // 2} AS qb FROM px),
p AS (SELECT x, round(qr * {prep.LUMA[0]} + qg * {prep.LUMA[1]} + qb * {prep.LUMA[2]}, 6) AS k FROM q),
nv AS (SELECT count(DISTINCT v) AS nv FROM (SELECT unnest([qr, qg, qb]) AS v FROM q)),
cent AS (SELECT k, avg(x) AS ck, count(*) AS nk, sum(x) AS y, sum(x * x) AS psi FROM p GROUP BY k),
pc AS (SELECT p.x, p.k, ck, nk FROM p JOIN cent USING (k)),
s AS (SELECT k, avg(abs(x - ck)) AS s FROM pc GROUP BY k),
nums AS (SELECT count(*) AS n, (SELECT count(*) FROM cent) AS kk, sum((x - ck) * (x - ck)) AS intra,
  sum((ck - (SELECT avg(x) FROM p)) * (ck - (SELECT avg(x) FROM p))) AS extra FROM pc),
dbr AS (SELECT a.k, max((sa.s + sb.s) / abs(a.ck - b.ck)) AS r FROM cent a JOIN cent b ON a.k <> b.k
  JOIN s sa ON sa.k = a.k JOIN s sb ON sb.k = b.k GROUP BY a.k),
xs AS (SELECT x, k, count(*) AS m FROM p GROUP BY x, k),
dis AS (SELECT xs.x, xs.k, xs.m, c.k AS c, c.nk, (c.nk * xs.x * xs.x - 2 * xs.x * c.y + c.psi) / c.nk AS d FROM xs, cent c),
pt AS (SELECT x, k, any_value(m) AS m, max(CASE WHEN c = k THEN nk END) AS own,
  max(CASE WHEN c = k AND nk > 1 THEN d * nk / (nk - 1) END) AS a, min(CASE WHEN c <> k THEN d END) AS b FROM dis GROUP BY x, k),
sil AS (SELECT sum(m * CASE WHEN own = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END) / sum(m) AS sil FROM pt),
o AS (SELECT sil AS silhouette, extra * (n - kk) / (intra * (kk - 1)) AS ch, (SELECT avg(r) FROM dbr) AS db, nv FROM sil, nums, nv)
SELECT round(ch, 6) AS calinski_harabasz, round(db, 6) AS davies_bouldin, round(silhouette, 6) AS silhouette,
  round(silhouette / nv, 6) AS silhouette_per_value, round(ch / nv, 6) AS calinski_harabasz_per_value,
  round(db / nv, 6) AS davies_bouldin_per_value FROM o""")
def q_ev13(spark, sf_dir):
    """Pixels of all values, each channel quantised to the middle of one of
    four equal byte levels; internal scores of the original gray levels
    against the quantised ones, also divided by the number of distinct
    quantised channel values. (ML-09 quantises by k-means, which has no SQL.)"""
    px = (_bytes(spark, sf_dir).groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("i", "byte"))).alias("l"))
          .select(F.inline(_triples(F.col("l.byte")))))
    level = {c: F.floor(F.col(c) / LEVEL) * LEVEL + LEVEL // 2 for c in "rgb"}
    # the quantised pixels feed four scores: written once, read by each
    q = materialize(px.select(
        F.array(prep.luminosity("r", "g", "b")).alias("g_"), F.array(*level.values()).alias("levels"),
        F.round(prep.luminosity(*level.values()), 6).alias("label")).withColumnRenamed("g_", "g"), "quantised")
    scores = cu.clustering_internal(q, vec="g", labels="label")
    sil = cu.silhouette(q, vec="g", labels="label")
    n = q.select(F.explode("levels").alias("v")).agg(F.countDistinct("v")).scalar()
    out = scores.select("*", sil.select("silhouette").scalar().alias("silhouette"))
    return comparable(out.select("*", *[(F.col(c) / n).alias(f"{c}_per_value")
                                        for c in ("silhouette", "calinski_harabasz", "davies_bouldin")]))


# ---------------------------------------------------------------------- IO

@register("io02_write_read_back", RP01_SQL)
def q_io02(spark, sf_dir):
    """IO-02 / IO-10: the report written as parquet and read back."""
    path = sinks.write_result(rp.risk_by_chunk(fx.train_games(spark, sf_dir), fx.TRAIN_HANDS),
                              scratch_path(spark, "rp01"))
    return comparable(load_result(spark, path))


@register("pr01_storage_index", """SELECT row_number() OVER () - 1 AS index, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem""")
def q_pr01_storage(spark, sf_dir):
    """Rows numbered as they are stored: no key, no shuffle."""
    rows = with_index(read_table(spark, sf_dir, "lineitem"))
    return rows.select("index", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("io03_report_job", RP01_SQL)
def q_io03(spark, sf_dir):
    """IO-03: the games written once, then the report job run twice into the
    same place, each publishing a version; returns what a reader gets."""
    src = sinks.write_result(fx.train_games(spark, sf_dir), scratch_path(spark, "games"))
    dst = scratch_path(spark, "report")

    def report(g):
        return rp.risk_by_chunk(g, fx.TRAIN_HANDS)
    sinks.run_report(spark, report, src, dst)
    sinks.run_report(spark, report, src, dst)
    return comparable(read_published(spark, dst))


@register("io09_table_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST((SELECT count(*) FROM information_schema.columns "
    f"WHERE table_name = '{t}') AS INTEGER) AS n_columns, count(*) AS n_rows FROM {t}" for t in TABLES))
def q_io09(spark, sf_dir):
    parts = [sinks.profile(read_table(spark, sf_dir, t), t).drop("schema") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("io01_pr03_raw_games_scan", f"""{episodes_sql(False)}
SELECT shown_cards[1] AS first_card, count(*) AS total_games,
  count(*) FILTER (WHERE result = 'Win') AS wins,
  round(count(*) FILTER (WHERE result = 'Win') / count(*), 6) AS win_rate
FROM r GROUP BY ALL""")
def q_io01(spark, sf_dir):
    """IO-01 / PR-03: a games table with the reference's raw column names
    (``Shown_cards``, ``Hand 0`` ..) written as parquet, scanned back with
    its footer schema, normalised, then reported (RP-03a, play)."""
    from ..functions.episodes import normalise_games
    from ..sources.tables import read_games
    g = fx.play_games(spark, sf_dir)
    raw = g.select("l_orderkey", F.col("shown_cards").alias("Shown_cards"),
                   *[F.col(f"hand_{k}").alias(f"Hand {k}") for k in range(fx.PLAY_HANDS)])
    path = sinks.write_result(raw, scratch_path(spark, "raw-games"))
    games = normalise_games(read_games(spark, path), fx.PLAY_HANDS)
    return comparable(rp.win_rate_by_first_card(games, fx.PLAY_HANDS, by_chunk=False))
