"""Registered queries and their independent SQL oracles.

``QUERIES[name](spark, sf_dir)`` returns a Spark DataFrame over the whole
given tables; ``ORACLES[name]`` is DuckDB SQL over the same tables written
from the definitions (SURVEY 1.1), not from the DataFrame code. Both sides
present arrays as comma-joined strings and doubles rounded to 6 places.
"""

from __future__ import annotations

from ..sources import fixtures as fx
from . import reports as rp
from .compare import comparable, nullable_ints_as_double
from .registry import ORACLES, QUERIES, register  # noqa: F401


# ---------------------------------------------------------------- SQL pieces

def _moves_sql(n_hands: int) -> str:
    seq = ["shown_cards"] + [f"hand_{k}" for k in range(n_hands)]
    terms = [
        f"(CASE WHEN {seq[j]}[1] IS NOT NULL AND {seq[j]}[1] <> {seq[j - 1]}[1] THEN 1 ELSE 0 END)"
        for j in range(1, n_hands)
    ]
    return "1 + " + " + ".join(terms)


def _final_sql(n_hands: int) -> str:
    return "coalesce(" + ", ".join(f"hand_{k}" for k in reversed(range(n_hands))) + ")"


RESULT_SQL = """CASE WHEN final_hand IS NULL THEN 'Unknown'
  WHEN final_hand[1] > 21 THEN 'Lose' WHEN final_hand[2] > 21 THEN 'Win'
  WHEN final_hand[1] > final_hand[2] THEN 'Win' WHEN final_hand[1] < final_hand[2] THEN 'Lose'
  ELSE 'Draw' END"""


def episodes_sql(train: bool) -> str:
    """CTEs ending in ``r``: one row per game with n_moves, final_hand,
    result (and chunk_number for the training games)."""
    n = fx.TRAIN_HANDS if train else fx.PLAY_HANDS
    games = fx.train_games_sql() if train else fx.play_games_sql()
    chunk = (",\n  CAST(floor((row_number() OVER (ORDER BY l_orderkey) - 1) / 500) AS BIGINT) AS chunk_number"
             if train else "")
    return f"""WITH {games},
e AS (SELECT l_orderkey, shown_cards, {_moves_sql(n)} AS n_moves,
  {_final_sql(n)} AS final_hand{chunk}
  FROM games),
r AS (SELECT *, {RESULT_SQL} AS result FROM e)"""


RISK_SQL = """CASE WHEN n_moves <= t[1] THEN 'Safe' WHEN n_moves <= t[2] THEN 'Tactical'
  WHEN n_moves <= t[3] THEN 'Risky' ELSE 'Suicidal' END"""
QUART_SQL = "q AS (SELECT quantile_disc(n_moves, [0.25, 0.5, 0.75]) AS t FROM r)"
UNIQUE_SQL = "array_to_string(list_sort(list_distinct(list(n_moves))), ',')"


# ------------------------------------------------------------------ reports

def _train(spark, sf_dir):
    return fx.train_games(spark, sf_dir)


def _play(spark, sf_dir):
    return fx.play_games(spark, sf_dir)


RP01_SQL = f"""{episodes_sql(True)}, {QUART_SQL}
SELECT chunk_number, {RISK_SQL} AS risk_level, count(*) AS count
FROM r, q GROUP BY ALL"""


@register("rp01_risk_by_chunk", RP01_SQL)
def q_rp01(spark, sf_dir):
    return comparable(rp.risk_by_chunk(_train(spark, sf_dir), fx.TRAIN_HANDS))


@register("rp02a_strategy_share_train", f"""{episodes_sql(True)}, {QUART_SQL}
SELECT chunk_number, {RISK_SQL} AS risk_level, count(*) AS count,
  round(count(*) * 100 / 500, 2) AS proportion, {UNIQUE_SQL} AS unique_moves
FROM r, q GROUP BY ALL""")
def q_rp02a(spark, sf_dir):
    return comparable(rp.strategy_share(_train(spark, sf_dir), fx.TRAIN_HANDS, by_chunk=True))


@register("rp02d_strategy_share_within_chunk", f"""{episodes_sql(True)}, {QUART_SQL},
c AS (SELECT chunk_number, {RISK_SQL} AS risk_level, count(*) AS count, {UNIQUE_SQL} AS unique_moves
      FROM r, q GROUP BY ALL)
SELECT chunk_number, risk_level, count,
  round(count * 100 / sum(count) OVER (PARTITION BY chunk_number), 2) AS proportion, unique_moves
FROM c""")
def q_rp02d(spark, sf_dir):
    """RP-02 with the group-size denominator: share of each level within
    its chunk (Q5)."""
    return comparable(rp.strategy_share(_train(spark, sf_dir), fx.TRAIN_HANDS, by_chunk=True,
                                        denom="group"))


@register("rp02b_strategy_share_play", f"""{episodes_sql(False)}, {QUART_SQL}
SELECT {RISK_SQL} AS risk_level, count(*) AS count,
  round(count(*) * 100 / (SELECT count(*) FROM r), 2) AS proportion, {UNIQUE_SQL} AS unique_moves
FROM r, q GROUP BY ALL""")
def q_rp02b(spark, sf_dir):
    return comparable(rp.strategy_share(_play(spark, sf_dir), fx.PLAY_HANDS,
                                        by_chunk=False, denom="total"))


@register("rp02c_strategy_share_play_per500", f"""{episodes_sql(False)}, {QUART_SQL}
SELECT {RISK_SQL} AS risk_level, count(*) AS count,
  round(count(*) * 100 / 500, 2) AS proportion, {UNIQUE_SQL} AS unique_moves
FROM r, q GROUP BY ALL""")
def q_rp02c(spark, sf_dir):
    return comparable(rp.strategy_share(_play(spark, sf_dir), fx.PLAY_HANDS,
                                        by_chunk=False, denom=500))


WIN_COLS_SQL = """count(*) AS total_games, count(*) FILTER (WHERE result = 'Win') AS wins,
  round(count(*) FILTER (WHERE result = 'Win') / count(*), 6) AS win_rate"""


@register("rp03a_win_rate_first_card_train", f"""{episodes_sql(True)}
SELECT shown_cards[1] AS first_card, chunk_number, {WIN_COLS_SQL}
FROM r GROUP BY ALL""")
def q_rp03a_train(spark, sf_dir):
    return comparable(rp.win_rate_by_first_card(_train(spark, sf_dir), fx.TRAIN_HANDS, by_chunk=True))


@register("rp03a_win_rate_first_card_play", f"""{episodes_sql(False)}
SELECT shown_cards[1] AS first_card, {WIN_COLS_SQL}
FROM r GROUP BY ALL""")
def q_rp03a_play(spark, sf_dir):
    return comparable(rp.win_rate_by_first_card(_play(spark, sf_dir), fx.PLAY_HANDS, by_chunk=False))


@register("rp03b_moves_by_shown_train", f"""{episodes_sql(True)}
SELECT chunk_number, array_to_string(shown_cards, ',') AS shown_cards, count(*) AS count,
  round(count(*) * 100 / 500, 2) AS proportion, {UNIQUE_SQL} AS unique_moves
FROM r GROUP BY chunk_number, r.shown_cards""")
def q_rp03b_train(spark, sf_dir):
    return comparable(rp.moves_by_shown(_train(spark, sf_dir), fx.TRAIN_HANDS, by_chunk=True))


@register("rp03b_moves_by_shown_play", f"""{episodes_sql(False)}
SELECT array_to_string(shown_cards, ',') AS shown_cards, count(*) AS count,
  round(count(*) * 100 / 500, 2) AS proportion, {UNIQUE_SQL} AS unique_moves
FROM r GROUP BY r.shown_cards""")
def q_rp03b_play(spark, sf_dir):
    return comparable(rp.moves_by_shown(_play(spark, sf_dir), fx.PLAY_HANDS, by_chunk=False))


RP04_PLAY_SQL = f"""{episodes_sql(False)}
SELECT final_hand[1] AS agent_hand, final_hand[1] - 21 AS distance_from_21, {WIN_COLS_SQL}
FROM r WHERE final_hand[1] - 21 <= 0 GROUP BY ALL"""


@register("rp04_win_rate_distance_train", f"""{episodes_sql(True)}
SELECT final_hand[1] AS agent_hand, chunk_number, final_hand[1] - 21 AS distance_from_21, {WIN_COLS_SQL}
FROM r WHERE final_hand[1] - 21 <= 0 GROUP BY ALL""")
def q_rp04_train(spark, sf_dir):
    return comparable(rp.win_rate_by_distance(_train(spark, sf_dir), fx.TRAIN_HANDS, by_chunk=True))


@register("rp04_win_rate_distance_play", RP04_PLAY_SQL)
def q_rp04_play(spark, sf_dir):
    return comparable(rp.win_rate_by_distance(_play(spark, sf_dir), fx.PLAY_HANDS, by_chunk=False))


HIT_COLS_SQL = """round(var_samp(n_moves), 6) AS hits_variance,
  array_to_string(list_transform(quantile_cont(n_moves, [0.25, 0.5, 0.75]), lambda x: round(x, 6)), ',') AS hits_quartiles,
  {u} AS unique_hits""".format(u=UNIQUE_SQL)


@register("rp05_hit_stats_train", f"""{episodes_sql(True)}
SELECT shown_cards[1] AS agent_first_card, shown_cards[2] AS opponent_first_card, chunk_number,
  {HIT_COLS_SQL}
FROM r GROUP BY ALL""")
def q_rp05_train(spark, sf_dir):
    return comparable(rp.hit_stats(_train(spark, sf_dir), fx.TRAIN_HANDS, by_chunk=True))


@register("rp05_hit_stats_play", f"""{episodes_sql(False)}
SELECT shown_cards[1] AS agent_first_card, shown_cards[2] AS opponent_first_card,
  {HIT_COLS_SQL}
FROM r GROUP BY ALL""")
def q_rp05_play(spark, sf_dir):
    return comparable(rp.hit_stats(_play(spark, sf_dir), fx.PLAY_HANDS, by_chunk=False))


@register("rp06_risk_pivot", f"""WITH base AS ({RP01_SQL})
SELECT chunk_number,
  CAST(max(CASE WHEN risk_level = 'Safe' THEN count END) AS DOUBLE) AS safe,
  CAST(max(CASE WHEN risk_level = 'Tactical' THEN count END) AS DOUBLE) AS tactical,
  CAST(max(CASE WHEN risk_level = 'Risky' THEN count END) AS DOUBLE) AS risky,
  CAST(max(CASE WHEN risk_level = 'Suicidal' THEN count END) AS DOUBLE) AS suicidal
FROM base GROUP BY chunk_number""")
def q_rp06(spark, sf_dir):
    pivot = rp.risk_pivot(rp.risk_by_chunk(_train(spark, sf_dir), fx.TRAIN_HANDS))
    return comparable(nullable_ints_as_double(pivot, ["safe", "tactical", "risky", "suicidal"]))


@register("rp07_win_matrix", "WITH base AS ({b})\nSELECT distance_from_21, {cols}\nFROM base GROUP BY distance_from_21".format(
    b=RP04_PLAY_SQL,
    cols=",\n  ".join(f"max(CASE WHEN agent_hand = {v} THEN win_rate END) AS \"hand_{v}\""
                      for v in rp.HAND_VALUES)))
def q_rp07(spark, sf_dir):
    return comparable(rp.win_matrix(rp.win_rate_by_distance(_play(spark, sf_dir), fx.PLAY_HANDS,
                                                            by_chunk=False)))


# ------------------------------------------------- join form and top-n

@register("jn01_win_rate_join", f"""{episodes_sql(False)}
SELECT shown_cards[1] AS first_card, {WIN_COLS_SQL}
FROM r GROUP BY ALL""")
def q_jn01(spark, sf_dir):
    """The reference's form of RP-03a: totals and wins aggregated apart,
    left-joined, missing wins -> 0."""
    from pyspark.sql import functions as F

    from ..functions.episodes import enrich
    from ..operators.aggregates import win_rate_join
    g = enrich(_play(spark, sf_dir), fx.PLAY_HANDS).select(
        F.col("agent_first_card").alias("first_card"), "result")
    totals = g.groupBy("first_card").agg(F.count(F.lit(1)).alias("total_games"))
    wins = g.filter(F.col("result") == "Win").groupBy("first_card").agg(F.count(F.lit(1)).alias("wins"))
    return comparable(win_rate_join(totals, wins, ["first_card"]))


TOP_N = 10


@register("so02_top_win_rates", f"""{episodes_sql(True)}
SELECT * FROM (SELECT shown_cards[1] AS first_card, chunk_number, {WIN_COLS_SQL}
               FROM r GROUP BY ALL)
ORDER BY win_rate DESC, total_games DESC, first_card, chunk_number LIMIT {TOP_N}""")
def q_so02(spark, sf_dir):
    """SO-02: the ten best (first card, chunk) win rates; the order is total
    (rate, games, card, chunk), so the limit is deterministic. Each task keeps
    only its own top ten before the final merge."""
    from pyspark.sql import functions as F

    from ..operators.aggregates import top_n
    w = rp.win_rate_by_first_card(_train(spark, sf_dir), fx.TRAIN_HANDS, by_chunk=True)
    return comparable(top_n(w, TOP_N, [F.desc("win_rate"), F.desc("total_games"),
                                       "first_card", "chunk_number"]))


@register("rp03c_outcomes_by_first_card", f"""{episodes_sql(False)}
SELECT shown_cards[1] AS first_card, result, count(*) AS count FROM r GROUP BY ALL""")
def q_rp03c(spark, sf_dir):
    """AG-01 with two keys: games per (first card, outcome), the breakdown
    behind the win rates."""
    from pyspark.sql import functions as F

    from ..functions.episodes import enrich
    from ..operators.aggregates import group_count
    g = enrich(_play(spark, sf_dir), fx.PLAY_HANDS).select(
        F.col("agent_first_card").alias("first_card"), "result")
    return comparable(group_count(g, ["first_card", "result"])
                      .orderBy(F.desc("count"), F.desc("first_card")))
