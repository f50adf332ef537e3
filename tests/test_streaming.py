"""Stream runs equal their static twins; late data by output mode;
restart on the same checkpoint."""

import json
import os
import time

from pyspark.sql import functions as F

from conftest import SF001
from playstream.streaming import queries as sq
from playstream.streaming.runner import run_to_table, start, stream_session, write_event_files
from playstream.streaming.sources import (
    NEWS_SCHEMA, decode_events, events_source, news_values, with_event_time,
)


def static_events(spark):
    return with_event_time(decode_events(news_values(spark, SF001).select("value")))


def stream_events(spark, path):
    path, files = path
    src = events_source(stream_session(spark), "text", path, maxFilesPerTrigger=files, recursiveFileLookup="true")
    return with_event_time(decode_events(src))


def test_stream_equals_static(spark, tmp_dir):
    path = write_event_files(spark, SF001, n_slices=4, path=os.path.join(tmp_dir, "topic"))
    static_spikes = sorted(sq.spikes(static_events(spark), "10 days", 5).collect())
    stream_spikes = sorted(run_to_table(sq.spikes(stream_events(spark, path), "10 days", 5),
                                        "t_spikes", "complete").collect())
    assert static_spikes == stream_spikes and static_spikes
    static_dev = sorted(sq.device_trends(static_events(spark)).collect())
    stream_dev = sorted(run_to_table(sq.device_trends(stream_events(spark, path)),
                                     "t_dev", "complete").collect())
    assert static_dev == stream_dev
    static_bots = sorted(sq.bot_users(static_events(spark), "1 day", 2).collect())
    stream_bots = sorted(run_to_table(sq.bot_users(stream_events(spark, path), "1 day", 2),
                                      "t_bots", "update").collect())
    assert static_bots == stream_bots and static_bots


def test_events_without_time_are_streamed(spark, tmp_dir):
    rows = [event(None), event("no time"), event("2024-02-30 10:00:00")] + [event(f"2024-01-{d:02d} 10:00:00", device="tablet") for d in range(1, 29)]
    values = spark.createDataFrame([(json.dumps(r), r["timestamp"]) for r in rows], "value string, timestamp string")
    path = write_event_files(spark, SF001, n_slices=3, path=os.path.join(tmp_dir, "null-topic"), values=values)
    static = sorted(sq.device_trends(with_event_time(decode_events(values))).collect())
    assert sorted(run_to_table(sq.device_trends(stream_events(spark, path)), "t_null", "complete").collect()) == static
    assert sum(r["count"] for r in static) == len(rows)


def test_stream_leaves_the_session_alone(spark, tmp_dir):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    own = stream_session(spark, 3)
    assert own.conf.get(key) == "3" and spark.conf.get(key) == before


def write_json_lines(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in rows:
            f.write(json.dumps({"value": json.dumps(r)}) + "\n")


def event(ts, device="mobile", article="a1", user="1"):
    return {"user_id": user, "article_id": article, "timestamp": ts, "category": "sports",
            "location": "X", "device_type": device, "session_id": "s"}


def json_source(spark, path):
    src = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).json(path)
    return with_event_time(decode_events(src))


def test_late_rows_by_output_mode(spark, tmp_dir):
    src = os.path.join(tmp_dir, "late")
    write_json_lines(src, "f1.json", [event("2024-01-01 10:00:00"), event("2024-01-01 12:00:00")])
    time.sleep(1.1)
    write_json_lines(src, "f2.json", [event("2024-01-01 12:30:00")])
    time.sleep(1.1)
    # Late input is filtered against the previous batch's watermark: by the
    # third batch it stands at 11:59, so a 10:05 row is late there.
    write_json_lines(src, "f3.json", [event("2024-01-01 10:05:00")])
    complete = run_to_table(sq.spikes(json_source(spark, src), "10 minutes", 1),
                            "t_late_complete", "complete")
    update = run_to_table(sq.spikes(json_source(spark, src), "10 minutes", 1),
                          "t_late_update", "update")
    win = F.col("window.start") == F.lit("2024-01-01 10:00:00").cast("timestamp")
    assert complete.filter(win).first()["count"] == 2      # complete mode keeps counting
    assert max(r["count"] for r in update.filter(win).collect()) == 1   # update mode drops it


def test_restart_on_same_checkpoint(spark, tmp_dir):
    src = os.path.join(tmp_dir, "restart")
    ckpt = os.path.join(tmp_dir, "ckpt")
    write_json_lines(src, "f1.json", [event("2024-01-01 10:00:00", device="tablet")] * 3)
    q = start(sq.device_trends(json_source(spark, src)), sink="memory", mode="complete",
              query_name="t_restart", available_now=True, checkpoint=ckpt)
    q.awaitTermination()
    assert spark.table("t_restart").first()["count"] == 3
    time.sleep(1.1)
    write_json_lines(src, "f2.json", [event("2024-01-01 10:01:00", device="tablet")] * 2)
    q = start(sq.device_trends(json_source(spark, src)), sink="memory", mode="complete",
              query_name="t_restart2", available_now=True, checkpoint=ckpt)
    q.awaitTermination()
    # only the new file is read; the count continues from the saved state
    assert spark.table("t_restart2").first()["count"] == 5


def test_malformed_value_gives_nulls(spark):
    df = spark.createDataFrame([("not json",), (json.dumps(event("zz")),)], "value string")
    rows = with_event_time(decode_events(df)).collect()
    assert rows[0]["user_id"] is None and rows[1]["event_time"] is None
    assert [f.name for f in NEWS_SCHEMA.fields][0] == "user_id"


def test_console_and_sorted_foreach_batch(spark, tmp_dir):
    """IO-07 console sink; SO-03: outside complete mode, sort each
    micro-batch inside foreachBatch."""
    src = os.path.join(tmp_dir, "fb")
    write_json_lines(src, "f1.json", [event("2024-01-01 10:00:00", article="a1")] * 2
                     + [event("2024-01-01 10:20:00", article="a2")] * 3)
    q = start(sq.spikes(json_source(spark, src), "10 minutes", 1), sink="console",
              mode="update", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    seen = []

    def sorted_batch(df, epoch_id):
        seen.extend(df.orderBy(F.col("window.end").desc(), F.col("count").desc()).collect())
    q = start(sq.spikes(json_source(spark, src), "10 minutes", 1), mode="update",
              available_now=True, foreach_batch=sorted_batch)
    q.awaitTermination()
    assert [r["count"] for r in seen] == [3, 2]


def test_rocksdb_state_store(spark, tmp_dir):
    from playstream.streaming.runner import use_rocksdb_state
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    use_rocksdb_state(spark)
    try:
        src = os.path.join(tmp_dir, "rocks")
        write_json_lines(src, "f1.json", [event("2024-01-01 10:00:00", device="tablet")] * 4)
        out = run_to_table(sq.device_trends(json_source(spark, src)), "t_rocks", "complete")
        assert out.first()["count"] == 4
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def test_append_mode_emits_closed_windows_once(spark, tmp_dir):
    """S-08 append: an alert appears once its window is closed by the
    watermark; the still-open last window is not emitted."""
    from playstream.streaming.runner import run_to_table
    src = os.path.join(tmp_dir, "append")
    write_json_lines(src, "f1.json", [event("2024-01-01 10:00:10", user="1")] * 3)
    time.sleep(1.1)
    write_json_lines(src, "f2.json", [event("2024-01-01 10:05:00", user="2")] * 3)
    out = run_to_table(sq.bot_alerts(json_source(spark, src), "1 minute", 2), "t_append", "append")
    users = sorted(r["user_id"] for r in out.collect())
    assert users[:1] == ["1"] and users.count("1") == 1


def test_stream_jobs_run_every_report(spark, tmp_dir):
    """The five stream jobs start on a file source and finish with
    availableNow; counts equal the static reports with the same defaults."""
    from playstream.streaming import jobs
    src = os.path.join(tmp_dir, "jobs")
    rows = [event("2024-01-01 10:00:00", user="7", article="a9") for _ in range(25)]
    write_json_lines(src, "f1.json", rows)
    for name in sorted(jobs.JOBS):
        q = jobs.run(spark, name, "json", src, {"maxFilesPerTrigger": "1"}, sink="memory",
                     query_name=f"job_{name}", available_now=True,
                     checkpoint=os.path.join(tmp_dir, f"ck_{name}"))
        q.awaitTermination()
        assert q.exception() is None
    assert [r["user_id"] for r in spark.table("job_bots").collect()] == ["7"]
    assert spark.table("job_devices").first()["count"] == 25
