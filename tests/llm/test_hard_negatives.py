import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from playstream.llm import hard_negatives as H

from .oracle import assert_matches_sql


def brute(rows, every=3, positives=5, negatives=3):
    ok = {}
    for i, e, lab in rows:
        if i is not None and lab is not None and e is not None and None not in e and np.isfinite(e).all():
            v = [math.floor(256 * float(x)) for x in e]
            key = (str(lab), len(v), np.array(v, dtype="<f8").tobytes())
            if i not in ok or key < ok[i][0]:
                ok[i] = (key, v, lab)
    out = []
    for a, (_, va, la) in ok.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, lab) for i, (_, v, lab) in ok.items() if len(v) == len(va) and i != a)
        for p, i, _ in [x for x in scored if x[2] == la][:positives]:
            window = [(n, j) for n, j, lab in scored if lab != la and -50 * p <= -100 * n <= -95 * p]
            out += [(a, i, r + 1, j, -p, -n) for r, (n, j) in enumerate(window[:negatives])]
    return sorted(out)


def run(spark, rows, every=3, **kw):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<double>, label int, score int, part string").repartition(5)
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % every == 0, **kw).collect())


def test_query_matches_sql(spark):
    assert_matches_sql(spark, "op11_hard_negatives")


def made(n, dim, seed, labels=4):
    rng = np.random.RandomState(seed)
    at = rng.randn(dim) * 2  # a common direction, so that scores of other labels reach the windows
    return [(int(i), (rng.randn(dim) + at).round(2).tolist(), int(rng.randint(labels))) for i in rng.permutation(n)]


def test_matches_brute_force(spark):
    rows = made(260, 6, 3)
    want = brute(rows)
    assert len(want) > 300
    assert run(spark, rows) == want
    assert run(spark, rows, anchor_bytes=2000) == want  # many blocks of anchors


def test_ties_and_groups_of_copies(spark):
    rows = [(i, [1.0, 0.5 if i % 2 else 0.25], i % 3) for i in range(400)] + [(1000 + i, [0.5, 0.5], 1) for i in range(300)]
    want = brute(rows, every=25)
    assert want
    assert run(spark, rows, every=25) == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.7, 0.6], 2), (3, None, 1), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [None, 1.0], 2),
            (7, [0.8, 0.8], None), (None, [0.8, 0.8], 2), (2, [0.7, 0.6], 2), (2, [0.1, 0.6], 2), (9, [1.0, 1.0, 1.0], 2), (12, [], 1), (15, [], 1), (18, [], 2),
            (21, [-1.0, -1.0], 3), (24, [1.0, 0.0], 3), (27, [0.0, -1.0], 3), (30, [0.0, 0.0], 4), (33, [0.0, 0.0], 4)]
    want = brute(rows)
    assert want
    assert run(spark, rows) == want
    assert run(spark, []) == [] and run(spark, rows[:1]) == []


@pytest.mark.parametrize("big", [3e5, 1e9, 1e300])
def test_scores_stay_integers_when_components_are_large(big):
    x, y = np.floor(np.array([[big, -big, 3.0], [1.0, 2.0, 3.0]])), np.floor(np.array([[big, big, 5.0]]))
    want = [[max(-H.LIMIT, min(H.LIMIT, sum(int(a) * int(b) for a, b in zip(r, s)))) for s in y] for r in x]
    assert H.inner(x, y).tolist() == want
