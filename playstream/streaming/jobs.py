"""Stream jobs: the five event reports as long-running queries.

    python -m playstream.streaming.jobs bots --format kafka \\
        --option kafka.bootstrap.servers=HOST:9094 --option subscribe=news_events \\
        --checkpoint /shared/ckpt/bots

Each job reads JSON ``value`` rows from the source, decodes them with the
fixed event schema, runs one report with the reference's defaults (window
sizes, thresholds, one-minute watermark, starting offsets) and writes to the sink (console by
default: first 10 rows, untruncated). Without ``--checkpoint`` the query
checkpoints under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from . import queries as sq
from .runner import start
from .sources import decode_events, events_source, with_event_time

# report -> (builder, output mode the reference uses)
JOBS = {
    "bots": (lambda ev: sq.bot_users(ev), "update"),
    "spikes": (lambda ev: sq.spikes(ev, sort=True), "complete"),
    "active": (lambda ev: sq.active_by_location(ev, sort=True), "complete"),
    "finance": (lambda ev: sq.category_by_location(ev, "finance", sort=True), "complete"),
    "devices": (lambda ev: sq.device_trends(ev, sort=True), "complete"),
}


def build(spark: SparkSession, job: str, fmt: str = "kafka", path: str | None = None,
          options: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    if fmt == "kafka":  # the reference's consumers read all that is kept, but for the bots
        options = {"startingOffsets": "latest" if job == "bots" else "earliest", **(options or {})}
    # file sources need a declared schema: the topic payload column
    schema = None if fmt == "kafka" else T.StructType([T.StructField("value", T.StringType())])
    src = events_source(spark, fmt, path, schema=schema, **(options or {}))
    report, mode = JOBS[job]
    return report(with_event_time(decode_events(src))), mode


def run(spark: SparkSession, job: str, fmt: str = "kafka", path: str | None = None,
        options: dict[str, str] | None = None, sink: str = "console",
        mode: str | None = None, checkpoint: str | None = None,
        query_name: str | None = None, available_now: bool = False,
        sink_path: str | None = None) -> StreamingQuery:
    df, default_mode = build(spark, job, fmt, path, options)
    return start(df, sink=sink, mode=mode or default_mode, checkpoint=checkpoint,
                 query_name=query_name or job, available_now=available_now, path=sink_path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Start one event report as a stream query.")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--format", default="kafka")
    ap.add_argument("--path")
    ap.add_argument("--option", action="append", default=[], help="key=value source option")
    ap.add_argument("--sink", default="console")
    ap.add_argument("--sink-path")
    ap.add_argument("--mode")
    ap.add_argument("--checkpoint")
    ap.add_argument("--available-now", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"playstream-{args.job}").getOrCreate()
    options = dict(o.split("=", 1) for o in args.option)
    q = run(spark, args.job, args.format, args.path, options, args.sink, args.mode,
            args.checkpoint, available_now=args.available_now, sink_path=args.sink_path)
    q.awaitTermination()


if __name__ == "__main__":
    main()
