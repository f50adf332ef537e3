"""Contiguous index and running sums without a single-task window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playstream.operators.index import with_chunk, with_index, with_running_sum


def test_index_equals_global_row_number(spark):
    random.seed(3)
    keys = random.sample(range(10_000_000), 5000)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k long, v long").repartition(9)
    ix = with_index(df, "k", base=1, num_partitions=6)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    joined = ix.join(ref, ["k", "v"])
    assert joined.count() == 5000
    assert joined.filter(F.col("index") != F.col("rn")).count() == 0


def test_chunks(spark):
    df = spark.range(0, 1234).withColumnRenamed("id", "k").repartition(5)
    sizes = {r[0]: r[1] for r in with_chunk(df, "k", size=500).groupBy("chunk_number").count().collect()}
    assert sizes == {0: 500, 1: 500, 2: 234}


def test_running_sum(spark):
    random.seed(5)
    rows = [(float(i) + random.random(), random.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "s double, n long").repartition(4)
    out = with_running_sum(df, "s", ["n"], num_partitions=5)
    ref = df.withColumn("ref", F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)))
    assert out.join(ref, ["s", "n"]).filter(F.col("n_cum") != F.col("ref")).count() == 0


def test_storage_index_over_several_files(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.range(0, 2500).select(F.col("id").alias("v"), (F.col("id") % 3).alias("w")).repartition(5).write.parquet(path)
    stored = spark.read.parquet(path)
    got = with_index(stored, base=1).collect()
    assert sorted(r["index"] for r in got) == list(range(1, 2501)) and {r["v"] for r in got} == set(range(2500))
    placed = stored.select("v", "_metadata.file_path", "_metadata.row_index").collect()
    want = [r["v"] for r in sorted(placed, key=lambda r: (r["file_path"], r["row_index"]))]
    assert [r["v"] for r in sorted(got, key=lambda r: r["index"])] == want
    plan = with_index(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Exchange range" not in plan


def test_repeated_key_is_refused(spark):
    with pytest.raises(ValueError, match="repeated"):
        with_index(spark.createDataFrame([(1,), (2,), (1,)], "k long"), "k")


def test_index_with_adaptive_partitions(spark):
    random.seed(9)
    keys = random.sample(range(1_000_000), 3000)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(6)
    ix = with_index(df, "k")
    got = sorted((r["k"], r["index"]) for r in ix.collect())
    assert [i for _, i in got] == list(range(3000))


def test_repeated_keys_are_found_without_a_shuffle_of_their_own(spark, monkeypatch):
    """The count of each key's rows reuses the range partitions and their order."""
    from pyspark.sql.readwriter import DataFrameWriter
    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).where("k < 4990")
    out = with_index(df, "k").orderBy("index").collect()
    assert [r["index"] for r in out] == list(range(len(out))) and [r["k"] for r in out] == sorted(r["k"] for r in out)
    ranged = [p for p in plans if "rangepartitioning" in p]
    assert len(ranged) == 1 and ranged[0].count("Exchange") == 1 and ranged[0].count("Sort ") == 1 and "Window" in ranged[0]
    assert not any("hashpartitioning(k" in p for p in plans)
