"""Card scoring, settlement and policy lookup (AG-11 .. AG-14, JN-02, JN-03).

The reference scores one hand at a time in Python loops. Here a hand is a
group of card rows: one aggregate gives the raw total and the ace count, and
the loop "while total > 21 and aces left: total -= 10" becomes the closed
form demote = least(aces, greatest(0, ceil((total - 21) / 10))).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET = 21

# Suit adjustments, rank names that count as ten, and the
# valid state ranges of the policy lookup.
SUIT_BONUS = {"hearts": 2, "diamonds": 1, "clubs": 0, "spades": -2}
FACE_NAMES = ("jack", "queen", "king")
NUMBER_NAMES = ("two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
TOTAL_RANGE = (-2, 32)
VISIBLE_RANGE = (-1, 12)
ACE_VALUES = (0, 1, 2)
STATE_KEYS = ["player_total", "dealer_visible_card", "usable_ace"]


def suit_bonus(suit: Column) -> Column:
    out = F.lit(0)
    for s, b in SUIT_BONUS.items():
        out = F.when(suit == s, F.lit(b)).otherwise(out)
    return out


def face_value(value: Column) -> Column:
    """J/Q/K = 10, A = 11, else the numeral (null if unreadable)."""
    return (F.when(value.isin("J", "Q", "K"), F.lit(10))
             .when(value == "A", F.lit(11))
             .otherwise(value.try_cast("int")))


def demoted(raw: Column, aces: Column) -> Column:
    """Number of aces counted as 1 so the total does not exceed 21."""
    return F.least(aces, F.greatest(F.lit(0), F.ceil((raw - TARGET) / 10.0).cast("int")))


def score_hands(cards: DataFrame, keys: list[str] | None = None,
                extra: list[Column] | None = None) -> DataFrame:
    """AG-11 / AG-12: per hand: raw_total, aces, score and usable_aces
    (``extra`` aggregates ride along in the same pass)."""
    keys = keys or ["hand_id"]
    extra = extra or []
    agg = cards.groupBy(*keys).agg(
        F.sum(face_value(F.col("value")) + suit_bonus(F.col("suit"))).cast("int").alias("raw_total"),
        F.count_if(F.col("value") == "A").cast("int").alias("aces"),
        *extra,
    )
    d = demoted(F.col("raw_total"), F.col("aces"))
    names = [c for c in agg.columns if c not in (*keys, "raw_total", "aces")]
    return agg.select(*keys, "raw_total", "aces", *names,
                      (F.col("raw_total") - 10 * d).alias("score"),
                      (F.col("aces") - d).alias("usable_aces"))


def visible_value(cards: DataFrame) -> DataFrame:
    """AG-13 (Q19): value of a card as the recogniser reports it: J/Q/K 10,
    A 11, a numeric rank takes the card's *true* numeral; plus the predicted
    suit's adjustment; an ace is demoted above 21. ``rejected`` marks cards
    whose value cannot be formed (unknown rank name, or a numeric rank on a
    card whose true value is not a numeral); their value is null."""
    cat = F.col("predicted_category")
    base = (F.when(cat.isin(*FACE_NAMES), F.lit(10))
             .when(cat == "ace", F.lit(11))
             .when(cat.isin(*NUMBER_NAMES), F.col("value").try_cast("int")))
    raw = base + suit_bonus(F.col("predicted_suit"))
    value = F.when((raw > TARGET) & (F.col("value") == "A"), raw - 10).otherwise(raw)
    return cards.withColumns({"visible_value": value, "rejected": base.isNull()})


def settle(player: Column, dealer: Column) -> Column:
    """AG-14: player bust loses first, then dealer bust wins, then the
    higher score wins; equal is a draw."""
    return (F.when(player > TARGET, "Lose").when(dealer > TARGET, "Win")
             .when(player > dealer, "Win").when(player < dealer, "Lose")
             .otherwise("Draw"))


def score_two_hands(cards: DataFrame, mine: Column, key: str = "hand_id") -> DataFrame:
    """Player hand = cards for which ``mine`` holds, dealer hand = the rest,
    scored in one aggregate per game; returns key, player_score,
    dealer_score, outcome."""
    pts = face_value(F.col("value")) + suit_bonus(F.col("suit"))
    ace = F.col("value") == "A"
    agg = cards.groupBy(key).agg(
        F.sum(F.when(mine, pts).otherwise(0)).cast("int").alias("p_raw"),
        F.count_if(mine & ace).cast("int").alias("p_aces"),
        F.sum(F.when(~mine, pts).otherwise(0)).cast("int").alias("d_raw"),
        F.count_if(~mine & ace).cast("int").alias("d_aces"),
    )
    p = F.col("p_raw") - 10 * demoted(F.col("p_raw"), F.col("p_aces"))
    d = F.col("d_raw") - 10 * demoted(F.col("d_raw"), F.col("d_aces"))
    return agg.select(key, p.alias("player_score"), d.alias("dealer_score")) \
              .withColumn("outcome", settle(F.col("player_score"), F.col("dealer_score")))


def state_reject_reason(df: DataFrame) -> Column:
    t, v, a = (F.col(c) for c in STATE_KEYS)
    return (F.when(t.isNull() | ~t.between(*TOTAL_RANGE), F.lit("player_total out of range"))
             .when(v.isNull() | ~v.between(*VISIBLE_RANGE), F.lit("dealer_visible_card out of range"))
             .when(a.isNull() | ~a.isin(*ACE_VALUES), F.lit("usable_ace out of range")))


def split_valid_states(states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN-03: (valid states, rejects with a ``reason``) instead of raising."""
    tagged = states.withColumn("reason", state_reject_reason(states))
    return (tagged.filter(F.col("reason").isNull()).drop("reason"),
            tagged.filter(F.col("reason").isNotNull()))


def apply_policy(states: DataFrame, q_table: DataFrame) -> DataFrame:
    """JN-02: action per state from the action-value table; a missing state
    counts as zeros; hit (1) only when its value is strictly higher, so a
    tie stands (0). The table is first restricted to valid states: at most
    35 x 14 x 3 = 1,470 keys, so broadcasting it is bounded by construction."""
    # integer keys: what makes the bound hold for any table given
    states, q_table = (df.withColumns({k: F.col(k).cast("int") for k in STATE_KEYS}) for df in (states, q_table))
    valid_q, _ = split_valid_states(q_table)
    # one row per state (a duplicate key, impossible in a lookup table,
    # would be averaged)
    q = valid_q.groupBy(*STATE_KEYS).agg(F.avg("q_stand").alias("q_stand"),
                                          F.avg("q_hit").alias("q_hit"))
    joined = states.join(F.broadcast(q), STATE_KEYS, "left")
    hit = F.coalesce(F.col("q_hit"), F.lit(0.0)) > F.coalesce(F.col("q_stand"), F.lit(0.0))
    return joined.withColumn("action", F.when(hit, 1).otherwise(0)).drop("q_stand", "q_hit")
