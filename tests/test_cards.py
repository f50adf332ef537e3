"""Card scoring, settlement, validation and the policy lookup."""

from pyspark.sql import functions as F

from playstream.operators import cards as cd


def loop_score(raw, aces):
    while raw > 21 and aces > 0:
        raw -= 10
        aces -= 1
    return raw, aces


def test_closed_form_equals_loop(spark):
    rows = [(s, a) for s in range(-10, 80) for a in range(5)]
    df = spark.createDataFrame(rows, "raw int, aces int")
    d = cd.demoted(F.col("raw"), F.col("aces"))
    got = df.select("raw", "aces", (F.col("raw") - 10 * d).alias("s"), (F.col("aces") - d).alias("u")).collect()
    for r in got:
        assert (r["s"], r["u"]) == loop_score(r["raw"], r["aces"])


def test_score_hands(spark):
    cards = spark.createDataFrame([
        (1, "A", "hearts"), (1, "K", "spades"), (1, "A", "clubs"),    # 11+2+10-2+11 = 32 -> 22 -> 12
        (2, "9", "diamonds"), (2, "7", "clubs"),                       # 9+1+7 = 17
    ], "hand_id long, value string, suit string")
    s = {r["hand_id"]: (r["score"], r["usable_aces"]) for r in cd.score_hands(cards).collect()}
    assert s[1] == (12, 0) and s[2] == (17, 0)


def test_visible_value_uses_true_numeral_and_rejects(spark):
    cards = spark.createDataFrame([
        ("7", "seven", "hearts"),    # 7 + 2
        ("7", "king", "spades"),     # 10 - 2
        ("9", "three", "clubs"),     # the true numeral: 9
        ("A", "two", "clubs"),       # numeric rank on an ace: rejected
        ("5", "joker", "clubs"),     # unknown rank name: rejected
        ("A", "ace", "hearts"),      # 11 + 2
    ], "value string, predicted_category string, predicted_suit string")
    got = [(r["visible_value"], r["rejected"]) for r in cd.visible_value(cards).collect()]
    assert got == [(9, False), (8, False), (9, False), (None, True), (None, True), (13, False)]


def test_settle(spark):
    df = spark.createDataFrame([(22, 25), (20, 22), (20, 19), (18, 19), (19, 19)], "p int, d int")
    got = [r[0] for r in df.select(cd.settle(F.col("p"), F.col("d"))).collect()]
    assert got == ["Lose", "Win", "Win", "Lose", "Draw"]


def test_policy_missing_key_and_tie_stand(spark):
    states = spark.createDataFrame([(1, 15, 10, 0), (2, 16, 10, 0), (3, 12, 3, 1)],
                                   "hand_id long, player_total int, dealer_visible_card int, usable_ace int")
    q = spark.createDataFrame([(15, 10, 0, 0.2, 0.5), (16, 10, 0, 0.4, 0.4), (40, 10, 0, 0.0, 9.0)],
                              "player_total int, dealer_visible_card int, usable_ace int, q_stand double, q_hit double")
    acts = {r["hand_id"]: r["action"] for r in cd.apply_policy(states, q).collect()}
    assert acts == {1: 1, 2: 0, 3: 0}


def test_split_valid_states(spark):
    states = spark.createDataFrame([(20, 5, 0), (33, 5, 0), (20, 13, 0), (20, 5, 3), (None, 5, 0)],
                                   "player_total int, dealer_visible_card int, usable_ace int")
    ok, bad = cd.split_valid_states(states)
    assert ok.count() == 1
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["dealer_visible_card out of range", "player_total out of range",
                       "player_total out of range", "usable_ace out of range"]
