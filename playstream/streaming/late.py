"""Feeds whose rows arrive late, and what a stream makes of them (S-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..session import scratch_path
from .runner import stream_session, write_slices
from .sources import decode_events, events_source, with_event_time


def write_late_feed(spark: SparkSession, values: DataFrame, arrival: Column, path: str | None = None) -> tuple[str, int]:
    """Writes ``values(value, ...)`` as a feed whose micro-batches are the
    ``arrival`` numbers (0, 1, ..), which need not follow the event times."""
    path = path or scratch_path(spark, "late-topic")
    return path, write_slices(spark, values.select("value", arrival.cast("int").alias("slice")), path)


def read_feed(spark: SparkSession, path: str, files: int) -> DataFrame:
    """The decoded stream, one arrival number per micro-batch."""
    src = events_source(stream_session(spark), "text", path, maxFilesPerTrigger=files, recursiveFileLookup="true")
    return with_event_time(decode_events(src))
