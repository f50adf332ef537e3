"""Whole reports over a games table (RP-01 .. RP-07).

Each takes a games table (``shown_cards, hand_0 ..``, for chunks an order key,
or an ``index`` column of games that are already numbered, named as the order
key) and returns a DataFrame. Reports by chunk or risk level write narrow
tables under the checkpoint folder while they are built. Parameters default to the
reference's constants (chunk size 500), except the quartile error: 0 gives
exact quartiles from a histogram of move counts, which is bounded by the
number of hands and so costs less than the approximate sketch; pass
``err=0.01`` for the reference's approximate thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.episodes import (
    RISK_LEVELS, SHOWN, enrich, n_moves, risk_level, with_distance,
)
from ..operators.aggregates import (
    group_count, hit_stats as _hit_stats, pivot_report, quartile_thresholds,
    strategy_profile, win_rate,
)
from ..operators.index import chunk_number, with_chunk
from ..session import materialize

CHUNK_SIZE = 500
ORDER_KEY = "l_orderkey"
INDEX = "index"


def _chunked(df: DataFrame, by_chunk: bool, order_key: str, size: int) -> DataFrame:
    if by_chunk and order_key == INDEX:
        return df.withColumn("chunk_number", chunk_number(INDEX, size)).drop(INDEX)
    return with_chunk(df, order_key, size).drop(INDEX) if by_chunk else df


def _key(by_chunk: bool, order_key: str) -> list[str]:
    """The order key is needed only to number games into chunks."""
    return [order_key] if by_chunk else []


def with_risk(games: DataFrame, n_hands: int, err: float = 0.0,
              keep: tuple[str, ...] = (ORDER_KEY,), by_chunk: bool = False,
              chunk_size: int = CHUNK_SIZE, order_key: str = ORDER_KEY) -> DataFrame:
    """n_moves (and chunk) per game with its risk level against the
    quartiles of all games.

    The narrow (key, n_moves) table is written once (the chunk numbering
    writes it anyway) and both the thresholds and the levels read it, so
    the games are derived from their source a single time."""
    moves = games.select(*keep, n_moves(n_hands).alias("n_moves"))
    moves = _chunked(moves, by_chunk, order_key, chunk_size)
    if not by_chunk or order_key == INDEX:  # else the numbering has written it
        moves = materialize(moves, "moves")
    q1, q2, q3 = quartile_thresholds(moves.select("n_moves"), "n_moves", err)
    return moves.withColumn("risk_level", risk_level(F.col("n_moves"), q1, q2, q3))


def risk_by_chunk(games: DataFrame, n_hands: int = 8, chunk_size: int = CHUNK_SIZE,
                  err: float = 0.0, order_key: str = ORDER_KEY) -> DataFrame:
    """RP-01: plays per risk level per chunk of consecutive games."""
    chunked = with_risk(games, n_hands, err, keep=(order_key,), by_chunk=True,
                        chunk_size=chunk_size, order_key=order_key)
    return group_count(chunked, ["chunk_number", "risk_level"]).orderBy("chunk_number", "count")


def strategy_share(games: DataFrame, n_hands: int = 8, by_chunk: bool = True,
                   denom: int | str = CHUNK_SIZE, chunk_size: int = CHUNK_SIZE,
                   err: float = 0.0, order_key: str = ORDER_KEY) -> DataFrame:
    """RP-02a (by chunk, share of the chunk size) and RP-02b (whole table,
    ``denom="total"`` for the true share or 500 for the reference's second
    play table)."""
    risk = with_risk(games, n_hands, err, keep=tuple(_key(by_chunk, order_key)),
                     by_chunk=by_chunk, chunk_size=chunk_size, order_key=order_key)
    keys = (["chunk_number"] if by_chunk else []) + ["risk_level"]
    out = strategy_profile(risk, keys, denom=denom)
    return out.orderBy(*(["chunk_number"] if by_chunk else []), "count")


def win_rate_by_first_card(games: DataFrame, n_hands: int = 8, by_chunk: bool = True,
                           chunk_size: int = CHUNK_SIZE,
                           order_key: str = ORDER_KEY) -> DataFrame:
    """RP-03a: games, wins and win rate per agent first card (and chunk)."""
    g = enrich(games, n_hands).select(*_key(by_chunk, order_key), "result",
                                      F.col("agent_first_card").alias("first_card"))
    g = _chunked(g, by_chunk, order_key, chunk_size)
    keys = ["first_card"] + (["chunk_number"] if by_chunk else [])
    return win_rate(g, keys).orderBy(F.desc("win_rate"))


def moves_by_shown(games: DataFrame, n_hands: int = 8, by_chunk: bool = True,
                   chunk_size: int = CHUNK_SIZE, order_key: str = ORDER_KEY) -> DataFrame:
    """RP-03b: count, share of 500 and distinct move counts per shown pair
    (an array-valued group key)."""
    g = games.select(*_key(by_chunk, order_key), SHOWN, n_moves(n_hands).alias("n_moves"))
    g = _chunked(g, by_chunk, order_key, chunk_size)
    keys = (["chunk_number"] if by_chunk else []) + [SHOWN]
    out = strategy_profile(g, keys, denom=chunk_size)
    return out.orderBy(*[F.desc(k) for k in (["chunk_number"] if by_chunk else [])],
                       F.desc("count"))


def win_rate_by_distance(games: DataFrame, n_hands: int = 8, by_chunk: bool = True,
                         chunk_size: int = CHUNK_SIZE,
                         order_key: str = ORDER_KEY) -> DataFrame:
    """RP-04: win rate per final agent total / distance to 21 (non-bust)."""
    g = enrich(games, n_hands).select(*_key(by_chunk, order_key), "final_hand", "result")
    # chunks number all games; the non-bust filter comes after
    g = with_distance(_chunked(g, by_chunk, order_key, chunk_size))
    keys = ["agent_hand"] + (["chunk_number"] if by_chunk else []) + ["distance_from_21"]
    return win_rate(g, keys).orderBy(F.desc("win_rate"))


def hit_stats(games: DataFrame, n_hands: int = 8, by_chunk: bool = True,
              chunk_size: int = CHUNK_SIZE, order_key: str = ORDER_KEY) -> DataFrame:
    """RP-05: consistency of the number of hits per (agent, opponent) first
    card: sample variance, exact quartiles, distinct values."""
    g = enrich(games, n_hands).select(*_key(by_chunk, order_key), "agent_first_card",
                                      "opponent_first_card",
                                      F.col("n_moves").alias("n_hits"))
    g = _chunked(g, by_chunk, order_key, chunk_size)
    keys = ["agent_first_card", "opponent_first_card"] + (["chunk_number"] if by_chunk else [])
    return _hit_stats(g, keys, col="n_hits")


def risk_pivot(report: DataFrame) -> DataFrame:
    """RP-06: risk-level counts per chunk as columns (from RP-01)."""
    return pivot_report(report, ["chunk_number"], "risk_level", "count",
                        list(RISK_LEVELS), [r.lower() for r in RISK_LEVELS])


# A non-bust final total lies in -2..21 (a suit may take 2 off).
HAND_VALUES = list(range(-2, 22))


def win_matrix(report: DataFrame) -> DataFrame:
    """RP-07: win rate, distance to 21 x agent total (from RP-04 play). A total
    outside the columns is an error, not a lost cell."""
    known = F.col("agent_hand").isNull() | F.col("agent_hand").between(HAND_VALUES[0], HAND_VALUES[-1])
    total = F.when(known, F.col("agent_hand")).otherwise(
        F.raise_error(F.concat(F.lit("no column for total "), F.col("agent_hand").cast("string"))))
    report = report.withColumn("agent_hand", total)
    return pivot_report(report, ["distance_from_21"], "agent_hand", "win_rate",
                        HAND_VALUES, [f"hand_{v}" for v in HAND_VALUES])
