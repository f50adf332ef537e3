"""Decision steps and baskets (ML-01, PR-14, PR-15, PR-24).

The reference walks each game in Python (an RDD ``flatMap``) and stringifies
items with a row-at-a-time UDF. Here both are higher-order array expressions
plus ``inline``: one narrow stage inside the JVM, no Python workers, and the
work per game is bounded by the number of hands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.episodes import SHOWN, hand_cols


def _prefix_len(hs: Column) -> Column:
    """PR-24: number of leading non-null hands (stop at the first null)."""
    pos = F.array_position(F.transform(hs, lambda h: h.isNull()), True)
    return F.when(pos == 0, F.size(hs)).otherwise(pos - 1).cast("int")


def step_array(n_hands: int) -> Column:
    """Array of (step, player_total, action) for one game. A step is ``hit``
    when a next hand exists and its agent total differs (null-safe, as a
    Python ``!=``), else ``stand``; steps end at the first stand."""
    hs = F.array(F.col(SHOWN), *[F.col(c) for c in hand_cols(n_hands)])
    n = _prefix_len(hs)
    totals = F.transform(F.slice(hs, 1, n), lambda h: F.get(h, 0))
    steps = F.transform(totals, lambda x, i: F.struct(
        i.alias("step"),
        x.alias("player_total"),
        F.when((i + 1 < n) & ~F.get(totals, i + 1).eqNullSafe(x), F.lit("hit"))
         .otherwise(F.lit("stand")).alias("action"),
    ))
    first_stand = F.array_position(F.transform(steps, lambda s: s["action"]), "stand")
    return F.slice(steps, 1, first_stand.cast("int"))


def decision_steps(games: DataFrame, n_hands: int, key: str | None = "l_orderkey") -> DataFrame:
    """ML-01: one row per decision: [key,] step, player_total, dealer_card,
    action (the game key is kept when the table has one)."""
    keys = [key] if key and key in games.columns else []
    return games.select(
        *keys, F.get(F.col(SHOWN), 1).alias("dealer_card"),
        F.inline(step_array(n_hands)),
    ).select(*keys, "step", "player_total", "dealer_card", "action")


def to_basket(steps: DataFrame, col: str = "features") -> DataFrame:
    """PR-14: ``[player_<total>, dealer_<card>, <action>]`` (a null number
    prints as ``None``, as the reference's f-string does)."""
    def tag(prefix: str, c: str) -> Column:
        return F.concat(F.lit(prefix), F.coalesce(F.col(c).cast("string"), F.lit("None")))
    return steps.withColumn(col, F.array(tag("player_", "player_total"),
                                         tag("dealer_", "dealer_card"), F.col("action")))


def to_features(steps: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """PR-15: numeric feature columns and the string label (after the columns
    to ``keep``); ``try_cast`` turns an unreadable value into null instead of
    an error."""
    return steps.select(
        *keep,
        F.col("player_total").try_cast("int").alias("player_total"),
        F.col("dealer_card").try_cast("int").alias("dealer_card"),
        F.col("action").alias("label_str"),
    )
