"""Per-game column expressions (PR-03 .. PR-11).

All are native Catalyst expressions evaluated inside whole-stage codegen; no
Python runs per row. Array reads use ``F.get`` (null when out of range) so an
empty or short array never raises under ANSI mode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHOWN = "shown_cards"
TARGET = 21

# Outcome labels and risk levels, in the reference's order.
RESULTS = ("Win", "Lose", "Draw", "Unknown")
RISK_LEVELS = ("Safe", "Tactical", "Risky", "Suicidal")


def hand_cols(n_hands: int) -> list[str]:
    return [f"hand_{k}" for k in range(n_hands)]


def first(c: Column | str) -> Column:
    return F.get(F.col(c) if isinstance(c, str) else c, 0)


def second(c: Column | str) -> Column:
    return F.get(F.col(c) if isinstance(c, str) else c, 1)


def normalise_games(df: DataFrame, n_hands: int, shown: str = "Shown_cards",
                    hand_name: str = "Hand {k}") -> DataFrame:
    """PR-03: rename a raw games table (``Shown_cards``, ``Hand 0`` ..) to
    ``shown_cards, hand_0 ..``; other columns are kept."""
    renames = {shown: SHOWN}
    renames.update({hand_name.format(k=k): f"hand_{k}" for k in range(n_hands)})
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def n_moves(n_hands: int, include_last: bool = False) -> Column:
    """PR-04 (Q1): 1 + number of hands whose agent total is present and
    differs from the previous hand (shown cards before hand 0). By default
    the last hand is never compared, as in the reference."""
    seq = [SHOWN] + hand_cols(n_hands)
    upto = len(seq) if include_last else len(seq) - 1
    steps = [
        F.when(first(seq[j]).isNotNull() & (first(seq[j]) != first(seq[j - 1])),
               F.lit(1)).otherwise(F.lit(0))
        for j in range(1, upto)
    ]
    return reduce(lambda a, b: a + b, steps, F.lit(1))


def final_hand(n_hands: int) -> Column:
    """PR-05: last non-null hand."""
    return F.coalesce(*[F.col(c) for c in reversed(hand_cols(n_hands))])


def result(final: Column) -> Column:
    """PR-06 (Q2): agent bust loses first, then opponent bust wins, then the
    higher total wins; equal or unreadable totals are a draw."""
    a, b = F.get(final, 0), F.get(final, 1)
    return (F.when(final.isNull(), "Unknown")
            .when(a > TARGET, "Lose")
            .when(b > TARGET, "Win")
            .when(a > b, "Win")
            .when(a < b, "Lose")
            .otherwise("Draw"))


def risk_level(moves: Column, q1: Column, q2: Column, q3: Column) -> Column:
    """PR-07: level from the three quartile thresholds (empty when equal)."""
    return (F.when(moves <= q1, "Safe")
            .when(moves <= q2, "Tactical")
            .when(moves <= q3, "Risky")
            .otherwise("Suicidal"))


def proportion(n: Column, denom: Column | int | float, scale: int = 2) -> Column:
    """PR-10: percentage rounded to ``scale`` decimals; null for a zero
    denominator instead of an ANSI error."""
    d = F.lit(denom) if isinstance(denom, (int, float)) else denom
    return F.round(F.try_divide(n * 100, d), scale)


def with_distance(df: DataFrame, target: int = TARGET) -> DataFrame:
    """PR-09 (Q8): agent final total and its distance to the target; keeps
    games that did not bust (a null distance is dropped too)."""
    return (df.withColumn("agent_hand", F.get(F.col("final_hand"), 0))
              .withColumn("distance_from_21", F.col("agent_hand") - target)
              .filter(F.col("distance_from_21") <= 0))


def enrich(games: DataFrame, n_hands: int) -> DataFrame:
    """Move count, final hand, outcome and first cards in one projection."""
    fh = final_hand(n_hands)
    return games.select(
        "*",
        n_moves(n_hands).alias("n_moves"),
        fh.alias("final_hand"),
        result(fh).alias("result"),
        first(SHOWN).alias("agent_first_card"),
        second(SHOWN).alias("opponent_first_card"),
    )
