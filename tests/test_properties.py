"""Property tests: random batches of games and keys against brute-force
definitions (one Spark job per example, a whole batch per job)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playstream.functions.episodes import enrich
from playstream.operators.index import with_index
from playstream.operators.sequences import decision_steps
from test_episodes import games
from test_sequences import reference_steps

N = 3
total = st.one_of(st.none(), st.integers(min_value=2, max_value=30))
hand = st.one_of(st.none(), st.lists(total, min_size=2, max_size=2))
game = st.tuples(hand, hand, hand, hand)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_result(hands):
    final = next((h for h in reversed(hands) if h is not None), None)
    if final is None:
        return "Unknown"
    a, b = final
    gt = lambda x, y: x is not None and y is not None and x > y
    if gt(a, 21):
        return "Lose"
    if gt(b, 21):
        return "Win"
    if gt(a, b):
        return "Win"
    if gt(b, a):
        return "Lose"
    return "Draw"


def brute_moves(shown, hands):
    seq = [shown] + hands
    first = [h[0] if h else None for h in seq]
    return 1 + sum(1 for j in range(1, len(seq) - 1)
                   if first[j] is not None and first[j - 1] is not None and first[j] != first[j - 1])


@SETTINGS
@given(st.lists(game, min_size=1, max_size=40))
def test_moves_and_results_match_definitions(spark, batch):
    rows = [(i,) + g for i, g in enumerate(batch)]
    got = {r["l_orderkey"]: (r["n_moves"], r["result"]) for r in enrich(games(spark, rows), N).collect()}
    for i, shown, *hands in rows:
        assert got[i] == (brute_moves(shown, hands), brute_result(hands)), (shown, hands)


@SETTINGS
@given(st.lists(game, min_size=1, max_size=40))
def test_steps_match_the_walk(spark, batch):
    rows = [(i,) + g for i, g in enumerate(batch)]
    got = {}
    for r in decision_steps(games(spark, rows), N).collect():
        got.setdefault(r["l_orderkey"], []).append((r["step"], r["player_total"], r["action"]))
    for i, shown, *hands in rows:
        assert sorted(got.get(i, [])) == reference_steps(shown, hands)


@SETTINGS
@given(st.sets(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=300),
       st.integers(min_value=1, max_value=7))
def test_index_is_the_sorted_rank(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(parts)
    got = dict((r["k"], r["index"]) for r in with_index(df, "k").collect())
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@SETTINGS
@given(st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=200))
def test_exact_quartiles_are_lower_quantiles(spark, values):
    import math

    from playstream.operators.aggregates import quartiles
    df = spark.createDataFrame([(v,) for v in values], "x int")
    s = sorted(values)
    want = [s[max(0, math.ceil(p * len(s)) - 1)] for p in (0.25, 0.5, 0.75)]
    assert quartiles(df, "x", err=0.0) == want
    assert [float(v) for v in want] == df.approxQuantile("x", [0.25, 0.5, 0.75], 0.0)
