"""Distinct sessions over any window (S-05) from sketches of short panes.

A pane is a tumbling window of a minute, say; per pane and key one HyperLogLog
sketch of the sessions is kept (a few kilobytes at most, whatever the traffic).
Sketches unite without loss, so the sessions of any window that is made of
panes, and of any coarser key, come from the stored panes, without reading the
events again. The same functions work on a static table and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .queries import WATERMARK, with_watermark

PANE = "1 minute"
#: log2 of a sketch's buckets, and the standard error of a united estimate.
LG_K = 12
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)


def session_panes(df: DataFrame, keys: list[str], col: str = "session_id", pane: str = PANE,
                  delay: str = WATERMARK, lg_k: int = LG_K) -> DataFrame:
    """``pane_start, keys, sketch, events``: one row per pane and key. On a
    stream each pane is put out once in append mode, when the watermark has
    passed it; null sessions count as events only."""
    out = with_watermark(df, delay).groupBy(F.window("event_time", pane).alias("pane"), *keys).agg(
        F.hll_sketch_agg(col, F.lit(lg_k)).alias("sketch"), F.count(F.lit(1)).alias("events"))
    return out.select(F.col("pane.start").alias("pane_start"), *keys, "sketch", "events")


def united(panes: DataFrame, size: str, keys: list[str], slide: str | None = None,
           where: Column | None = None) -> DataFrame:
    """``window, keys, sessions, events`` from panes: windows of ``size``
    (every ``slide``, else tumbling), ``keys`` being some of the panes' keys.
    ``size`` and ``slide`` must be multiples of the pane."""
    src = panes if where is None else panes.where(where)
    window = F.window("pane_start", size, slide) if slide else F.window("pane_start", size)
    return src.groupBy(window.alias("window"), *keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sessions"), F.sum("events").alias("events"))
