"""The batch job over raw-named game tables equals the registered reports."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from playstream import jobs
from playstream.plans import reports as rp
from playstream.session import ensure_checkpoint_dir
from playstream.sources import fixtures as fx
from playstream.sources.publish import read_published, versions


def raw(g, n):
    return g.select("l_orderkey", F.col("shown_cards").alias("Shown_cards"),
                    *[F.col(f"hand_{k}").alias(f"Hand {k}") for k in range(n)])


def test_job_writes_every_report(spark, tmp_dir):
    train = os.path.join(tmp_dir, "train")
    play = os.path.join(tmp_dir, "play")
    raw(fx.train_games(spark, SF001), fx.TRAIN_HANDS).write.parquet(train)
    raw(fx.play_games(spark, SF001), fx.PLAY_HANDS).write.parquet(play)
    out = os.path.join(tmp_dir, "out")
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    written = jobs.run(spark, train, play, out)
    assert set(written) == set(jobs.REPORTS)
    got = sorted(spark.read.parquet(written["rp04_win_rate_distance_play"]).collect())
    want = sorted(rp.win_rate_by_distance(fx.play_games(spark, SF001), fx.PLAY_HANDS, False).collect())
    assert got == want
    made = {f.rsplit("-", 1)[0] for f in set(os.listdir(scratch)) - before}
    assert not made & {"numbered", "steps", "range-input", "ranged", "offsets"}     # scratch is dropped
    again = jobs.run(spark, train, play, out, ["rp01_risk_by_chunk"])      # rerun overwrites
    assert spark.read.parquet(again["rp01_risk_by_chunk"]).agg(F.sum("count")).first()[0] == \
        fx.train_games(spark, SF001).count()


def test_job_on_tables_without_a_key(spark, tmp_dir):
    """The stored order numbers the games; no report is skipped."""
    train, play, out = (os.path.join(tmp_dir, x) for x in ("train", "play", "out"))
    raw(fx.train_games(spark, SF001), fx.TRAIN_HANDS).drop("l_orderkey").write.parquet(train)
    raw(fx.play_games(spark, SF001), fx.PLAY_HANDS).drop("l_orderkey").write.parquet(play)
    written = jobs.run(spark, train, play, out, display_names=True)
    assert set(written) == set(jobs.REPORTS)
    n = fx.train_games(spark, SF001).count()
    rows = spark.read.parquet(written["rp01_risk_by_chunk"]).groupBy("Chunk Number").agg(F.sum("count").alias("n")).collect()
    assert {r["Chunk Number"]: r["n"] for r in rows} == {k: min(500, n - 500 * k) for k in range((n + 499) // 500)}
    assert "Winning Rate Proportion" in spark.read.parquet(written["rp04_win_rate_distance_play"]).columns


def test_job_publishes_versions_and_knows_its_key(spark, tmp_dir):
    train, play, out = (os.path.join(tmp_dir, x) for x in ("train", "play", "out"))
    raw(fx.train_games(spark, SF001), fx.TRAIN_HANDS).write.parquet(train)
    raw(fx.play_games(spark, SF001), fx.PLAY_HANDS).write.parquet(play)
    for _ in range(2):
        written = jobs.run(spark, train, play, out, ["rp04_win_rate_distance_play"], order_key="l_orderkey", versions=True)
    path = written["rp04_win_rate_distance_play"]
    assert len(versions(spark, path)) == 2
    assert sorted(read_published(spark, path).collect()) == sorted(rp.win_rate_by_distance(fx.play_games(spark, SF001), fx.PLAY_HANDS, False).collect())
    with pytest.raises(ValueError, match="no column"):
        jobs.run(spark, train, play, out, ["rp01_risk_by_chunk"], order_key="game")
