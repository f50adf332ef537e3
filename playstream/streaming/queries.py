"""Windowed event reports (S-01 .. S-07, S-09, PR-12).

Every function takes a static or a streaming DataFrame with ``event_time``.
On a stream, state is keyed by (window, key) and shuffled on that key into
the state store; the watermark bounds how long a window stays open for
late rows. Sorting is legal only for complete-mode output, so ``sort=True``
is for static frames and complete mode.

Late data (S-09): in update and append mode a row is dropped when its event
time is behind the watermark of the previous micro-batch (state for its
window has then been evicted); complete mode keeps every window and counts
late rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's window sizes, thresholds and watermark.
WATERMARK = "1 minute"
BOT_WINDOW, BOT_THRESHOLD = "1 minute", 20
SPIKE_WINDOW, SPIKE_THRESHOLD = "10 minutes", 250
ACTIVE_MINUTES = 5
FINANCE_MINUTES = 15


def with_watermark(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """S-01 (no-op on a static frame)."""
    return df.withWatermark("event_time", delay)


def window_count(df: DataFrame, size: str, keys: list[str]) -> DataFrame:
    """S-02: tumbling window (origin 1970-01-01 UTC) count per key."""
    return df.groupBy(F.window("event_time", size).alias("window"), *keys).count()


def flat_window(df: DataFrame) -> DataFrame:
    """``window`` struct -> ``window_start``, ``window_end`` columns."""
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"),
                     *[c for c in df.columns if c != "window"])


def recent(df: DataFrame, minutes: int | None = None, as_of: Column | None = None,
           interval: str | None = None) -> DataFrame:
    """PR-12: rows no older than the interval before ``as_of`` (default the
    current time, as the reference does)."""
    now = as_of if as_of is not None else F.current_timestamp()
    span = F.expr(f"INTERVAL {interval}") if interval else F.expr(f"INTERVAL {minutes} MINUTES")
    return df.filter(F.col("event_time") >= now - span)


def category(df: DataFrame, value: str) -> DataFrame:
    """PR-12: equality filter on the category field."""
    return df.filter(F.col("category") == value)


def bot_users(df: DataFrame, size: str = BOT_WINDOW, threshold: int = BOT_THRESHOLD,
              delay: str = WATERMARK) -> DataFrame:
    """S-03: users with at least ``threshold`` events in one window,
    deduplicated (Q14: run in update mode; the dedup state holds one entry
    per flagged user)."""
    counts = window_count(with_watermark(df, delay), size, ["user_id"])
    return counts.filter(F.col("count") >= threshold).select("user_id").distinct()


def bot_alerts(df: DataFrame, size: str = BOT_WINDOW, threshold: int = BOT_THRESHOLD,
               delay: str = WATERMARK) -> DataFrame:
    """S-03, bounded-time variant: one alert per (window, user) with its
    count. In append mode each alert is emitted once, when the watermark
    passes the window end, and the window state is then evicted; a user may
    alert again in a later window."""
    counts = window_count(with_watermark(df, delay), size, ["user_id"])
    return (counts.filter(F.col("count") >= threshold)
                  .select("window", "user_id", "count"))


def spikes(df: DataFrame, size: str = SPIKE_WINDOW, threshold: int = SPIKE_THRESHOLD,
           delay: str = WATERMARK, sort: bool = False) -> DataFrame:
    """S-04: articles read at least ``threshold`` times in a window."""
    out = (window_count(with_watermark(df, delay), size, ["article_id"])
           .filter(F.col("count") >= threshold)
           .select("window", "article_id", "count"))
    return out.orderBy(F.col("window.end").desc(), F.col("count").desc()) if sort else out


def active_by_location(df: DataFrame, minutes: int = ACTIVE_MINUTES, size: str | None = None,
                       as_of: Column | None = None, distinct: bool = False,
                       delay: str = WATERMARK, sort: bool = False) -> DataFrame:
    """S-05: events (or approximately distinct sessions) per location per
    window over the last ``minutes``. The reference counts events."""
    size = size or f"{minutes} minutes"
    src = with_watermark(recent(df, minutes, as_of), delay)
    grouped = src.groupBy(F.window("event_time", size).alias("window"), "location")
    out = (grouped.agg(F.approx_count_distinct("session_id").alias("count")) if distinct
           else grouped.count())
    out = out.select("window", "location", "count")
    return out.orderBy(F.col("window.end").desc(), F.col("count").desc()) if sort else out


def category_by_location(df: DataFrame, value: str = "finance",
                         minutes: int = FINANCE_MINUTES, size: str | None = None,
                         as_of: Column | None = None, delay: str = WATERMARK,
                         sort: bool = False) -> DataFrame:
    """S-06: events of one category per location per window, recent only."""
    size = size or f"{minutes} minutes"
    src = with_watermark(category(recent(df, minutes, as_of), value), delay)
    out = window_count(src, size, ["location"]).select("window", "location", "count")
    return out.orderBy(F.col("window.end").desc(), F.col("count").desc()) if sort else out


def device_trends(df: DataFrame, delay: str = WATERMARK, sort: bool = False) -> DataFrame:
    """S-07: running events per device type (Q13: no time in the key, so the
    state is one row per device type: small, but never evicted)."""
    out = with_watermark(df, delay).groupBy("device_type").count()
    return out.orderBy(F.col("count").desc()) if sort else out
