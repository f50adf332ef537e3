import pytest
from pyspark.sql import functions as F

from playstream.operators.metrics.registry import store_metrics
from playstream.sources import publish as P


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_versions_replace_each_other(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, tmp_dir)
    assert numbers(P.publish(spark.range(3).toDF("x"), tmp_dir)) == [0, 1, 2]
    first = P.read_published(spark, tmp_dir)
    assert numbers(P.publish(first.select((F.col("x") + 10).alias("x")), tmp_dir)) == [10, 11, 12]  # reads what it replaces
    assert numbers(first) == [0, 1, 2]  # a reader that has begun keeps its version
    P.publish(spark.range(1).toDF("x"), tmp_dir)
    assert len(P.versions(spark, tmp_dir)) == 2
    assert numbers(P.read_published(spark, tmp_dir)) == [0]


def test_a_run_that_fails_midway_leaves_the_old_version(spark, tmp_dir):
    P.publish(spark.range(4).toDF("x"), tmp_dir)
    before = P.current_version(spark, tmp_dir)
    bad = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        P.publish(bad, tmp_dir)
    assert P.current_version(spark, tmp_dir) == before
    assert numbers(P.read_published(spark, tmp_dir)) == [0, 1, 2, 3]
    assert numbers(P.publish(spark.range(2).toDF("x"), tmp_dir)) == [0, 1]


def test_stored_registry(spark, tmp_dir):
    def rows(*of):
        return spark.createDataFrame(of, "algorithm string, mae double")

    def told(df):
        return sorted((r.algorithm, r.run, r.mae) for r in df.collect())
    assert told(store_metrics(rows(("a", 1.0), ("b", 2.0)), tmp_dir, run=1)) == [("a", 1, 1.0), ("b", 1, 2.0)]
    more = spark.createDataFrame([("b", 0.5), ("c", 0.7)], "algorithm string, f1 double")
    second = store_metrics(more, tmp_dir, run=2)
    want = [("a", 1, 1.0), ("b", 2, None), ("c", 2, None)]
    assert told(second) == want and {r.algorithm: r.f1 for r in second.collect()} == {"a": None, "b": 0.5, "c": 0.7}
    assert told(store_metrics(more, tmp_dir, run=2)) == want  # a retry
    assert told(store_metrics(rows(("b", 9.0)), tmp_dir, run=1)) == want  # an older run comes late
    assert told(store_metrics(spark.createDataFrame([("b", 0.6)], "algorithm string, f1 double"), tmp_dir, run=2)) == want
    assert {r.algorithm: r.f1 for r in P.read_published(spark, tmp_dir).collect()}["b"] == 0.6
