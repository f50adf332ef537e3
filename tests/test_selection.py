import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playstream.operators import selection as S
from playstream.operators.aggregates import quartile_values


def lower(values, p):
    values = sorted(v for v in values if v is not None)
    return values[max(math.ceil(p * len(values)), 1) - 1] if values else None


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(allow_nan=False)), max_size=60), st.sampled_from([0.0, 0.3, 0.5, 0.99, 1.0]))
def test_any_values(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert S.exact_quantiles(df, "x", [p]) == [lower(values, p)]


def test_many_values_take_few_rounds(spark, monkeypatch):
    rng = np.random.RandomState(2)
    values = np.concatenate([rng.lognormal(3, 2, 40_000), np.full(5_000, 7.25), rng.randint(0, 9, 3_000)]).tolist()
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    rounds = []
    real = S._Search.narrow
    monkeypatch.setattr(S._Search, "narrow", lambda self, told: (rounds.append(self.rank), real(self, told))[1])
    probs = (0.01, 0.25, 0.5, 0.75, 0.999)
    assert S.exact_quantiles(df, "x", probs) == [lower(values, p) for p in probs]
    assert max(rounds.count(r) for r in rounds) <= 5


def test_dates_decimals_and_longs(spark):
    df = spark.range(1000).select(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("d"),
                                  (F.col("id") * (2**53)).alias("l"), (F.col("id") / 8).cast("decimal(12,3)").alias("c"))
    assert S.exact_quantiles(df, "d", [0.5]) == [dt.date(2020, 1, 1) + dt.timedelta(days=499)]
    assert S.exact_quantiles(df, "l", [0.25, 0.5]) == [249 * 2**53, 499 * 2**53]
    assert float(S.exact_quantiles(df, "c", [0.5])[0]) == 499 / 8


def test_quartiles_choose_their_way_by_type(spark):
    df = spark.range(101).select((F.col("id") % 7).cast("int").alias("i"), (F.col("id") * 1.5).alias("x"))
    assert quartile_values(df, "i").first()["q"] == quartile_values(df, "i", counted=False).first()["q"] == [1, 3, 5]
    assert quartile_values(df, "x").first()["q"] == [37.5, 75.0, 112.5]
    assert quartile_values(df.where("x < 0"), "x").first()["q"] is None


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_sketches_merge_to_their_bound(spark, keys):
    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 40).alias("chunk"), F.rand(5).alias("x"))
    merged = S.merge_sketches(S.quantile_sketches(df, ["k", "chunk"], "x"), keys)
    rows = merged.select("n", S.sketch_quantiles(probs=(0.1, 0.5, 0.9)).alias("q")).collect()
    assert sum(r.n for r in rows) == 200_000 and len(rows) == (3 if keys else 1)
    assert all(abs(a - b) < 2 * S.KLL_RANK_ERROR for r in rows for a, b in zip(r.q, (0.1, 0.5, 0.9)))


def test_prices_stay_where_they_are_read(spark):
    """Each flag's quantiles come to the prices, not a flag's prices to one task."""
    from playstream.plans.catalog_quantiles import q_ag08_sketches
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = q_ag08_sketches(spark, "/root/testdata/sf0.001")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert all(r.rank_fits for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
