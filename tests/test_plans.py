"""Physical-plan properties that the scale design relies on."""

import random

from pyspark.sql import functions as F

from conftest import SF001
from playstream.functions.episodes import enrich
from playstream.operators import aggregates as ag
from playstream.session import materialize
from playstream.sources import fixtures as fx

# (the no-cross-join / no-Python-UDF check of every registered query runs
# with the oracle tests, on the same executions)


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_games_top_k_runs_before_the_shuffle(spark):
    plan = fx.train_games(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in l)
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    assert partial > exchange          # printed below = runs before the exchange
    assert sum("Exchange" in l for l in lines) == 1


def test_games_scan_reads_only_needed_columns(spark):
    plan = fx.train_games(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    schema = next(l for l in plan.splitlines() if "ReadSchema" in l)
    for unused in ("l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in schema


def test_hot_order_is_bounded_and_exact(spark):
    """One order holding a third of all lines: its hands come from its first
    lines only, the same as a brute-force walk."""
    random.seed(8)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else 1000 + i
        rows.append((key, random.randint(1, 500), random.randint(1, 50), i % 7 + 1,
                     float(random.randint(1, 50)), float(random.randint(1, 10_000))))
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, "
                                     "l_linenumber int, l_quantity double, l_extendedprice double") \
              .withColumn("l_shipdate", F.lit("2024-01-01").cast("timestamp"))
    games = fx.derive_games(li.repartition(6), 3, 20)
    hot = games.filter(F.col("l_orderkey") == 1).first()
    lines = sorted([r for r in rows if r[0] == 1], key=lambda r: (r[3], r[1], r[2], r[5], r[4]))[:4]
    a = b = 0
    fa = fb = None
    hands = []
    for p, r in enumerate(lines, start=1):
        a += r[1] % 8 + 3
        b += r[2] % 8 + 3
        fa = fa if fa is not None else (a if a >= 20 else None)
        fb = fb if fb is not None else (b if b >= 16 else None)
        if p == 1:
            shown = [r[1] % 8 + 3, r[2] % 8 + 3]
        else:
            hands.append([fa if fa is not None else a, fb if fb is not None else b])
    assert hot["shown_cards"] == shown
    assert [hot["hand_0"], hot["hand_1"], hot["hand_2"]] == hands
    assert games.count() == len({r[0] for r in rows})


def test_aggregates_are_partial_before_the_shuffle(spark):
    g = materialize(enrich(fx.train_games(spark, SF001), fx.TRAIN_HANDS), "plan-games")
    for out, part in ((ag.group_count(g, ["agent_first_card"]), "partial_count"),
                      (ag.win_rate(g, ["agent_first_card"]), "partial_count"),
                      (ag.hit_stats(g, ["agent_first_card"], col="n_moves"), "partial_")):
        plan = executed_plan(out)
        assert part in plan and plan.count("Exchange hashpartitioning") == 1
