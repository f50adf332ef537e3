"""Episode and event tables derived from the given TPC-H-like tables.

The reference analyses parquet tables of finished card games and a stream of
news events; neither ships with it. These functions derive tables of the same
shape from ``lineitem`` / ``events`` / ``nation`` so every report runs over
whole given tables and its work grows with them.

Games: one order is one game, one line (in a fixed total order) is one drawn
card pair of 3 to 10 points each. With ``n`` hands only the first ``n + 1``
lines can matter: 7 lines of at least 3 points make 21, past every stop value,
so all totals are frozen by then and later lines change no hand. Line 1 gives the shown cards, line k+2 gives hand k as running
totals [agent, opponent] that freeze once they reach the player's stop value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the derivation (see FIXTURES.md).
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
              "l_shipdate", "l_quantity")
OPPONENT_STOP = 16
TRAIN_HANDS = 8
PLAY_HANDS = 6
PLAY_AGENT_STOP = 17


def train_agent_stop() -> Column:
    """Exploring policy of the training games: stop at 15..18 by order."""
    return F.lit(15) + F.col("l_orderkey") % 4


def derive_games(lineitem: DataFrame, n_hands: int, agent_stop: Column | int,
                 opponent_stop: int = OPPONENT_STOP) -> DataFrame:
    """Wide games table: ``l_orderkey, shown_cards, hand_0 .. hand_{n-1}``.

    Plan: hash exchange on ``l_orderkey`` with a partial per-order top-(n+1)
    before the shuffle (WindowGroupLimit), so an order with very many lines
    ships at most n+1 rows per map task; the running totals and the pivot to
    hands then reuse that partitioning (no further exchange).
    """
    agent_stop = F.lit(agent_stop) if isinstance(agent_stop, int) else agent_stop
    lines = lineitem.select(
        "l_orderkey", *LINE_ORDER[1:], "l_linenumber",
    )
    by_order = Window.partitionBy("l_orderkey")
    ranked = (
        lines.withColumn("p", F.row_number().over(by_order.orderBy(*LINE_ORDER)))
        .filter(F.col("p") <= n_hands + 1)
        .select(
            "l_orderkey", "p",
            (F.col("l_partkey") % 8 + 3).cast("int").alias("v"),
            (F.col("l_suppkey") % 8 + 3).cast("int").alias("u"),
            agent_stop.cast("int").alias("agent_stop"),
        )
    )
    running = by_order.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    totals = ranked.select(
        "l_orderkey", "p", "v", "u", "agent_stop",
        F.sum("v").over(running).cast("int").alias("cv"),
        F.sum("u").over(running).cast("int").alias("cu"),
    )
    # Totals only grow, so the first total at or over the stop value is the
    # running minimum of the qualifying totals.
    frozen = totals.select(
        "l_orderkey", "p", "v", "u",
        F.coalesce(F.min(F.when(F.col("cv") >= F.col("agent_stop"), F.col("cv")))
                   .over(running), F.col("cv")).alias("a"),
        F.coalesce(F.min(F.when(F.col("cu") >= opponent_stop, F.col("cu")))
                   .over(running), F.col("cu")).alias("b"),
    )
    hands = [
        F.max(F.when(F.col("p") == k + 2, F.array("a", "b"))).alias(f"hand_{k}")
        for k in range(n_hands)
    ]
    return frozen.groupBy("l_orderkey").agg(
        F.max(F.when(F.col("p") == 1, F.array("v", "u"))).alias("shown_cards"),
        *hands,
    )


def train_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_games(read_table(spark, sf_dir, "lineitem"), TRAIN_HANDS,
                        train_agent_stop())


def play_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_games(read_table(spark, sf_dir, "lineitem"), PLAY_HANDS,
                        PLAY_AGENT_STOP)


def games_sql(n_hands: int, agent_stop_sql: str,
              opponent_stop: int = OPPONENT_STOP) -> str:
    """DuckDB text of the same derivation, written from the definition
    above (used by the oracle statements)."""
    order = ", ".join(LINE_ORDER)
    hands = ",\n  ".join(
        f"max(CASE WHEN p = {k + 2} THEN [a, b] END) AS hand_{k}"
        for k in range(n_hands)
    )
    return f"""
x AS (
  SELECT l_orderkey, CAST(l_partkey % 8 + 3 AS INTEGER) AS v,
         CAST(l_suppkey % 8 + 3 AS INTEGER) AS u,
         CAST({agent_stop_sql} AS INTEGER) AS agent_stop,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS p
  FROM lineitem),
y AS (
  SELECT *, CAST(sum(v) OVER r AS INTEGER) AS cv, CAST(sum(u) OVER r AS INTEGER) AS cu
  FROM x
  WINDOW r AS (PARTITION BY l_orderkey ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
z AS (
  SELECT *, coalesce(min(CASE WHEN cv >= agent_stop THEN cv END) OVER r, cv) AS a,
            coalesce(min(CASE WHEN cu >= {opponent_stop} THEN cu END) OVER r, cu) AS b
  FROM y
  WINDOW r AS (PARTITION BY l_orderkey ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
games AS (
  SELECT l_orderkey, max(CASE WHEN p = 1 THEN [v, u] END) AS shown_cards,
  {hands}
  FROM z GROUP BY l_orderkey)"""


def train_games_sql() -> str:
    return games_sql(TRAIN_HANDS, "15 + l_orderkey % 4")


def play_games_sql() -> str:
    return games_sql(PLAY_HANDS, str(PLAY_AGENT_STOP))


# ----------------------------------------------------------------- cards
# Rank names in rank order with their face values, and suits.
RANK_NAMES = ("two", "three", "four", "five", "six", "seven", "eight", "nine",
              "ten", "jack", "queen", "king", "ace")
RANK_VALUES = ("2", "3", "4", "5", "6", "7", "8", "9", "10", "J", "Q", "K", "A")
SUITS = ("hearts", "diamonds", "clubs", "spades")


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def cards(lineitem: DataFrame) -> DataFrame:
    """One card per line: hand_id, rank index, suit, value, predicted
    category / suit. The recogniser is wrong (next rank) on every line whose
    quantity is a multiple of 10. No window: a line is a card on its own."""
    rank = (F.col("l_partkey") % 13).cast("int")
    wrong = (F.col("l_quantity").cast("int") % 10 == 0).cast("int")
    pred = ((rank + wrong) % 13).cast("int")
    suit = _pick(SUITS, F.col("l_suppkey") % 4)
    return lineitem.select(
        F.col("l_orderkey").alias("hand_id"),
        rank.alias("rank_idx"), pred.alias("pred_idx"),
        suit.alias("suit"), _pick(RANK_VALUES, rank).alias("value"),
        _pick(RANK_NAMES, rank).alias("category"),
        _pick(RANK_NAMES, pred).alias("predicted_category"),
        suit.alias("predicted_suit"),
        *LINE_ORDER,
    )


def cards_sql() -> str:
    """CTE ``cards`` (one row per line) in DuckDB."""
    names = ", ".join(f"'{n}'" for n in RANK_NAMES)
    return f"""cards AS (
  SELECT l_orderkey AS hand_id, CAST(l_partkey % 13 AS INTEGER) AS rank_idx,
    CAST((l_partkey % 13 + CASE WHEN CAST(floor(l_quantity) AS INTEGER) % 10 = 0 THEN 1 ELSE 0 END) % 13 AS INTEGER) AS pred_idx
  FROM lineitem),
named AS (
  SELECT *, ([{names}])[rank_idx + 1] AS y_true, ([{names}])[pred_idx + 1] AS y_pred FROM cards)"""
