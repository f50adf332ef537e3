import pytest
from pyspark.sql import functions as F

from playstream.functions import permutation as P


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 65, 1000, 4097, 30_011])
def test_one_to_one(spark, n):
    got = [r[0] for r in spark.range(n).select(P.permuted(F.col("id"), n, 9)).collect()]
    assert sorted(got) == list(range(n))
    if n > 60:
        assert sum(i == p for i, p in enumerate(got)) < 12  # few stay where they were
        assert sum(abs(a - b) == 1 for a, b in zip(got, got[1:])) < 0.05 * n + 5  # neighbours part


def test_seeds_differ_and_repeat(spark):
    a, b, c = ([r[0] for r in spark.range(500).select(P.permuted(F.col("id"), 500, s)).collect()] for s in (1, 1, 2))
    assert a == b != c


def test_large_places_stay_in_range(spark):
    n = 2**59 + 12345
    got = [r[0] for r in spark.range(n - 200, n).select(P.permuted(F.col("id"), n)).collect()]
    assert len(set(got)) == 200 and 0 <= min(got) and max(got) < n
    with pytest.raises(ValueError):
        P.permuted(F.col("id"), 2**60)


def test_table_is_not_shuffled(spark, tmp_dir):
    spark.range(5000).repartition(6).write.parquet(f"{tmp_dir}/t")
    out = P.permute(spark.read.parquet(f"{tmp_dir}/t"), seed=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan and "SinglePartition" not in plan
    assert sorted(r.position for r in out.collect()) == list(range(5000))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, P.permute(spark.read.parquet(f"{tmp_dir}/t"), seed=3).collect()))
