"""Registered queries: windowed event reports (S-02 .. S-09), each as a
static twin with an SQL oracle, and the stream runs of the same operators
(file source, availableNow, files of each micro-batch) checked against the same SQL.

Window sizes and thresholds are scaled to the test events (30 days, a few
events per user and day), where the reference's minute-scale values select
nothing (FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import late
from ..streaming import panes as pn
from ..streaming import queries as sq
from ..streaming.runner import event_topic, numbered_values, run_counted, run_restarted, run_to_table, stream_session, write_slices
from ..session import materialize, scratch_path
from ..sources.tables import read_table
from ..streaming.sources import NEWS_FIELDS, decode_events, events_source, news_events, news_values, with_event_time
from .compare import comparable
from .registry import register

BOT_SIZE, BOT_MIN = "1 day", 7
SPIKE_SIZE, SPIKE_MIN = "10 days", 40
RECENT_MINUTES, RECENT_SIZE = 1440, "1 day"

NEWS_SQL = """WITH news AS (
  SELECT CAST(e.user_id AS VARCHAR) AS user_id,
    'a' || json_extract_string(e.props, '$.k') AS article_id,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
    CASE WHEN e.event_type = 'purchase' THEN 'finance' ELSE e.event_type END AS category,
    n.n_name AS location,
    CASE e.event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
    CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y%m%d') AS session_id
  FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25),
ev AS (SELECT *, TRY_CAST(timestamp AS TIMESTAMP) AS event_time FROM news)"""


def _win(size: str) -> str:
    b = f"time_bucket(INTERVAL '{size}', event_time, TIMESTAMP '1970-01-01')"
    return (f"strftime({b}, '%Y-%m-%d %H:%M:%S') AS window_start, "
            f"strftime({b} + INTERVAL '{size}', '%Y-%m-%d %H:%M:%S') AS window_end")


def _grp(size: str) -> str:
    return f"time_bucket(INTERVAL '{size}', event_time, TIMESTAMP '1970-01-01')"


def _events(spark, sf_dir):
    """Static twin of the decoded topic: JSON values -> fields -> event time."""
    return with_event_time(decode_events(news_values(spark, sf_dir).select("value")))


def _direct(spark, sf_dir):
    """The events with their time, without the JSON round trip."""
    return with_event_time(news_events(spark, sf_dir))


def _latest(spark, sf_dir):
    """The latest event time, from the one column that has it."""
    t = read_table(spark, sf_dir, "events").select(F.max("ts").alias("t"))
    return t.select(F.date_trunc("second", "t")).scalar()


def _stream(spark, sf_dir):
    path, files = event_topic(spark, sf_dir)
    src = events_source(stream_session(spark), "text", path, maxFilesPerTrigger=files, recursiveFileLookup="true")
    return with_event_time(decode_events(src))


S02_SQL = f"""{NEWS_SQL}
SELECT {_win(RECENT_SIZE)}, location, count(*) AS count FROM ev
WHERE event_time IS NOT NULL GROUP BY {_grp(RECENT_SIZE)}, location"""


@register("s02_window_count", S02_SQL)
def q_s02(spark, sf_dir):
    return comparable(sq.flat_window(sq.window_count(_events(spark, sf_dir), RECENT_SIZE, ["location"])))


BOTS_SQL = f"""{NEWS_SQL},
w AS (SELECT user_id, count(*) AS c FROM ev WHERE event_time IS NOT NULL
      GROUP BY {_grp(BOT_SIZE)}, user_id)
SELECT DISTINCT user_id FROM w WHERE c >= {BOT_MIN}"""


@register("s03_bot_users", BOTS_SQL)
def q_s03(spark, sf_dir):
    return comparable(sq.bot_users(_direct(spark, sf_dir), BOT_SIZE, BOT_MIN))


@register("s03b_bot_alerts", f"""{NEWS_SQL}
SELECT {_win(BOT_SIZE)}, user_id, count(*) AS count FROM ev WHERE event_time IS NOT NULL
GROUP BY {_grp(BOT_SIZE)}, user_id HAVING count(*) >= {BOT_MIN}""")
def q_s03b(spark, sf_dir):
    return comparable(sq.flat_window(sq.bot_alerts(_direct(spark, sf_dir), BOT_SIZE, BOT_MIN)))


SPIKES_SQL = f"""{NEWS_SQL}
SELECT {_win(SPIKE_SIZE)}, article_id, count(*) AS count FROM ev WHERE event_time IS NOT NULL
GROUP BY {_grp(SPIKE_SIZE)}, article_id HAVING count(*) >= {SPIKE_MIN}"""


@register("s04_spikes", SPIKES_SQL)
def q_s04(spark, sf_dir):
    return comparable(sq.flat_window(sq.spikes(_direct(spark, sf_dir), SPIKE_SIZE, SPIKE_MIN, sort=True)))


def _recent_sql(extra: str = "") -> str:
    return f"""{NEWS_SQL}
SELECT {_win(RECENT_SIZE)}, location, count(*) AS count FROM ev
WHERE event_time >= (SELECT max(event_time) FROM ev) - INTERVAL '{RECENT_MINUTES} minutes' {extra}
GROUP BY {_grp(RECENT_SIZE)}, location"""


@register("s05_active_by_location", _recent_sql())
def q_s05(spark, sf_dir):
    ev = _direct(spark, sf_dir)
    out = sq.active_by_location(ev, RECENT_MINUTES, RECENT_SIZE, as_of=_latest(spark, sf_dir), sort=True)
    return comparable(sq.flat_window(out))


@register("s05b_active_sessions_distinct", f"""{NEWS_SQL}
SELECT {_win(RECENT_SIZE)}, location, count(DISTINCT session_id) AS sessions, true AS estimate_fits FROM ev
WHERE event_time >= (SELECT max(event_time) FROM ev) - INTERVAL '{RECENT_MINUTES} minutes'
GROUP BY {_grp(RECENT_SIZE)}, location""")
def q_s05b(spark, sf_dir):
    """Exact distinct sessions, and whether the report's estimate
    (HyperLogLog++, 5 % standard error) is within three errors of them."""
    ev = materialize(sq.recent(_direct(spark, sf_dir), RECENT_MINUTES, _latest(spark, sf_dir)), "recent")
    told = sq.active_by_location(ev, RECENT_MINUTES, RECENT_SIZE, as_of=F.lit(0).cast("timestamp"), distinct=True)
    exact = ev.groupBy(F.window("event_time", RECENT_SIZE).alias("window"), "location").agg(
        F.count_distinct("session_id").alias("sessions"))
    near = F.abs(F.col("count") - F.col("sessions")) <= F.greatest(F.lit(1.0), 0.15 * F.col("sessions"))
    out = exact.join(told, (exact["window"] == told["window"]) & exact["location"].eqNullSafe(told["location"]))
    return comparable(sq.flat_window(out.select(exact["window"], exact["location"], "sessions", near.alias("estimate_fits"))))


@register("s06_category_by_location", _recent_sql("AND category = 'finance'"))
def q_s06(spark, sf_dir):
    ev = _direct(spark, sf_dir)
    out = sq.category_by_location(ev, "finance", RECENT_MINUTES, RECENT_SIZE,
                                  as_of=_latest(spark, sf_dir), sort=True)
    return comparable(sq.flat_window(out))


DEVICE_SQL = f"""{NEWS_SQL}
SELECT device_type, count(*) AS count FROM ev GROUP BY device_type"""


@register("s07_device_trends", DEVICE_SQL)
def q_s07(spark, sf_dir):
    return comparable(sq.device_trends(_direct(spark, sf_dir), sort=True))


# --------------------------------------------------------------- stream runs

@register("stream_s03_bot_users", BOTS_SQL)
def q_stream_s03(spark, sf_dir):
    """Update mode: each flagged user is emitted once (dedup state)."""
    out = run_to_table(sq.bot_users(_stream(spark, sf_dir), BOT_SIZE, BOT_MIN),
                       "stream_bot_users", "update")
    return comparable(out)


@register("stream_s04_spikes", SPIKES_SQL)
def q_stream_s04(spark, sf_dir):
    """Complete mode, sorted by window end and count."""
    out = run_to_table(sq.spikes(_stream(spark, sf_dir), SPIKE_SIZE, SPIKE_MIN, sort=True),
                       "stream_spikes", "complete")
    return comparable(sq.flat_window(out))


@register("stream_s06_category_by_location", _recent_sql("AND category = 'finance'"))
def q_stream_s06(spark, sf_dir):
    """Complete mode with a fixed 'now' (the latest event time, one value)."""
    as_of = read_table(spark, sf_dir, "events").agg(F.date_trunc("second", F.max("ts"))).first()[0]
    out = run_to_table(sq.category_by_location(_stream(spark, sf_dir), "finance", RECENT_MINUTES,
                                               RECENT_SIZE, as_of=F.lit(as_of), sort=True),
                       "stream_finance", "complete")
    return comparable(sq.flat_window(out))


@register("stream_s07_device_trends", DEVICE_SQL)
def q_stream_s07(spark, sf_dir):
    out = run_to_table(sq.device_trends(_stream(spark, sf_dir), sort=True),
                       "stream_devices", "complete")
    return comparable(out)



@register("stream_s02_window_count", S02_SQL)
def q_stream_s02(spark, sf_dir):
    """Complete mode: every (day, location) window."""
    out = run_to_table(sq.window_count(_stream(spark, sf_dir), RECENT_SIZE, ["location"]),
                       "stream_windows", "complete")
    return comparable(sq.flat_window(out))


@register("stream_s05_active_by_location", _recent_sql())
def q_stream_s05(spark, sf_dir):
    """Complete mode with a fixed 'now' (the latest event time, one value)."""
    as_of = read_table(spark, sf_dir, "events").agg(F.date_trunc("second", F.max("ts"))).first()[0]
    out = run_to_table(sq.active_by_location(_stream(spark, sf_dir), RECENT_MINUTES, RECENT_SIZE,
                                             as_of=F.lit(as_of), sort=True),
                       "stream_active", "complete")
    return comparable(sq.flat_window(out))


# ------------------------------------------------- panes of distinct sessions (S-05)

PANE, PANE_WINDOWS = "6 hours", ("1 day", "5 days")


def _panes_sql(keys: str) -> str:
    return f"{NEWS_SQL}\n" + " UNION ALL ".join(
        f"SELECT '{size}' AS size, {_win(size)}, {keys} count(DISTINCT session_id) AS sessions, count(*) AS events, true AS estimate_fits "
        f"FROM ev WHERE event_time IS NOT NULL GROUP BY ALL" for size in PANE_WINDOWS)


def _panes_told(panes, exact_of, keys):
    """Windows of several sizes united from the same panes, beside the exact
    number of sessions."""
    out = None
    for size in PANE_WINDOWS:
        told = pn.united(panes, size, keys).withColumnRenamed("sessions", "told")
        exact = exact_of.groupBy(F.window("event_time", size).alias("window"), *keys).agg(F.count_distinct("session_id").alias("sessions"))
        on = [told["window"] == exact["window"], *[told[k].eqNullSafe(exact[k]) for k in keys]]
        near = F.abs(F.col("told") - F.col("sessions")) <= F.greatest(F.lit(1.0), 3 * pn.STANDARD_ERROR * F.col("sessions"))
        row = sq.flat_window(told.join(exact, on).select(told["window"], *[told[k] for k in keys], "sessions", "events", near.alias("estimate_fits")))
        row = row.select(F.lit(size).alias("size"), "*")
        out = row if out is None else out.unionAll(row)
    return comparable(out)


@register("s05c_session_panes", _panes_sql("location,"))
def q_s05c(spark, sf_dir):
    """A sketch of sessions per pane of six hours and location, united to days
    and to five days: exact sessions, and whether the estimate is within three
    standard errors of them."""
    ev = materialize(_direct(spark, sf_dir).where("event_time is not null").select("event_time", "location", "session_id"), "pane-events")
    return _panes_told(materialize(pn.session_panes(ev, ["location"], pane=PANE), "panes"), ev, ["location"])


@register("stream_s05c_session_panes", _panes_sql(""))
def q_stream_s05c(spark, sf_dir):
    """The panes as a stream writes them, united over all locations."""
    panes = run_to_table(pn.session_panes(_stream(spark, sf_dir), ["location"], pane=PANE), "stream_panes", "complete")
    ev = _direct(spark, sf_dir).where("event_time is not null").select("event_time", "session_id")
    return _panes_told(panes.where("pane_start is not null"), ev, [])


# ------------------------------------------------- late rows (S-09, S-01)

LATE_DAYS, LATE_SLICES, LATE_EVERY, LATE_BY = 5, 6, 7, 2


def _late_values(spark, sf_dir):
    """Events with the number of the micro-batch that brings them: five days
    of event time each, but every seventh event comes two batches late."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    start = ev.select(F.date_trunc("day", F.min("ts"))).scalar()
    of_day = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(start)) / (86400 * LATE_DAYS))
    late = F.when(F.col("event_id") % LATE_EVERY == 0, LATE_BY).otherwise(0)
    arrival = F.coalesce(F.least(of_day, F.lit(LATE_SLICES - 1)) + late, F.lit(0)).cast("int")
    numbered = ev.select("event_id", arrival.alias("arrival"))
    keyed = news_events(spark, sf_dir, keep=("event_id",))
    return keyed.join(numbered, "event_id").select(F.to_json(F.struct(*NEWS_FIELDS)).alias("value"), "arrival")


def _late_sql(kept_only: bool) -> str:
    """The watermark of a batch is the latest time of the batches before it,
    less a minute. A stateful operator drops a row of batch i whose window had
    ended by the watermark of batch i - 1, at which it was last evicted."""
    b = _grp(RECENT_SIZE)
    keep = "WHERE wm IS NULL OR w_end > wm" if kept_only else ""
    return f"""{NEWS_SQL.replace("session_id\n  FROM", "session_id, e.event_id, e.ts\n  FROM")},
arr AS (SELECT *, coalesce(least(CAST(floor((epoch(date_trunc('second', ts)) - epoch((SELECT date_trunc('day', min(ts)) FROM events))) / {86400 * LATE_DAYS}) AS INTEGER), {LATE_SLICES - 1})
    + CASE WHEN event_id % {LATE_EVERY} = 0 THEN {LATE_BY} ELSE 0 END, 0) AS batch FROM ev),
top AS (SELECT batch, max(event_time) AS t FROM arr GROUP BY batch),
wm AS (SELECT x.batch, (SELECT max(t) - INTERVAL 1 MINUTE FROM top WHERE top.batch < x.batch - 1) AS wm FROM top x),
seen AS (SELECT a.*, {b} + INTERVAL '{RECENT_SIZE}' AS w_end, wm.wm FROM arr a JOIN wm USING (batch) WHERE event_time IS NOT NULL),
kept AS (SELECT * FROM seen {keep})"""


@register("stream_s09_late_rows_update", _late_sql(True) + f"""
SELECT {_win(RECENT_SIZE)}, location, count(*) AS count, (SELECT count(*) FROM kept) < (SELECT count(*) FROM seen) AS some_dropped FROM kept GROUP BY ALL""")
def q_stream_s09_update(spark, sf_dir):
    """Update mode over a feed with late rows: the last count of each window,
    without the rows whose window the watermark had passed; whether the state
    operators counted dropped rows."""
    values = materialize(_late_values(spark, sf_dir), "late-values")
    feed = late.read_feed(spark, *late.write_late_feed(spark, values, F.col("arrival")))
    out, dropped = run_counted(sq.window_count(sq.with_watermark(feed), RECENT_SIZE, ["location"]), "stream_late_update", "update")
    last = out.groupBy("window", "location").agg(F.max("count").alias("count"))
    return comparable(sq.flat_window(last.withColumn("some_dropped", F.lit(dropped > 0))))


@register("stream_s09_late_rows_complete", _late_sql(False) + f"""
SELECT {_win(RECENT_SIZE)}, location, count(*) AS count, false AS some_dropped FROM kept GROUP BY ALL""")
def q_stream_s09_complete(spark, sf_dir):
    """Complete mode over the same feed keeps every window and counts all rows."""
    values = materialize(_late_values(spark, sf_dir), "late-values")
    feed = late.read_feed(spark, *late.write_late_feed(spark, values, F.col("arrival")))
    out, dropped = run_counted(sq.window_count(sq.with_watermark(feed), RECENT_SIZE, ["location"]), "stream_late_complete", "complete")
    return comparable(sq.flat_window(out.withColumn("some_dropped", F.lit(dropped > 0))))


# ------------------------------------------------- restarts (IO-08, S-08) and first rows (IO-07)

def _in_parts(spark, sf_dir, report, name, mode, n_slices=6, **how):
    """The feed's first half, a query over it, the second half, and a new
    query on the same checkpoint."""
    path = scratch_path(spark, "news-parts")
    numbered = materialize(numbered_values(spark, news_values(spark, sf_dir), n_slices), "news-numbered")
    files = []

    def arrive(first: bool):
        files[:] = [write_slices(spark, numbered, path, files[0] if files else None, lambda i: (i < n_slices // 2) == first)]

    def make():
        src = events_source(stream_session(spark), "text", path, maxFilesPerTrigger=files[0], recursiveFileLookup="true")
        return report(with_event_time(decode_events(src)))
    return run_restarted(make, [lambda: arrive(True), lambda: arrive(False)], name, mode, **how)


@register("stream_io08_restart_update", BOTS_SQL)
def q_stream_restart_update(spark, sf_dir):
    """Bots in update mode, stopped after half of the feed and restarted:
    windows that were half counted go on, and nobody is flagged twice."""
    return comparable(_in_parts(spark, sf_dir, lambda ev: sq.bot_users(ev, BOT_SIZE, BOT_MIN), "restart_bots", "update"))


@register("stream_s08_restart_append", f"""{NEWS_SQL}
SELECT {_win(BOT_SIZE)}, user_id, count(*) AS count FROM ev
WHERE event_time IS NOT NULL GROUP BY {_grp(BOT_SIZE)}, user_id
HAVING count(*) >= {BOT_MIN} AND {_grp(BOT_SIZE)} + INTERVAL '{BOT_SIZE}' <= (SELECT max(event_time) - INTERVAL 1 MINUTE FROM ev)""")
def q_stream_restart_append(spark, sf_dir):
    """Alerts in append mode over a restart: each window once, when the
    watermark has passed it; those still open at the end are not put out."""
    out = _in_parts(spark, sf_dir, lambda ev: sq.bot_alerts(ev, BOT_SIZE, BOT_MIN), "restart_alerts", "append")
    return comparable(sq.flat_window(out))


@register("stream_io07_first_rows", f"""{SPIKES_SQL.replace(f"HAVING count(*) >= {SPIKE_MIN}", "")}
ORDER BY window_end DESC, count DESC, article_id LIMIT 10""")
def q_stream_first(spark, sf_dir):
    """The ten rows that a console shows of the last result: newest windows,
    then most read."""
    out = run_to_table(sq.window_count(_stream(spark, sf_dir).where("event_time is not null"), SPIKE_SIZE, ["article_id"]), "stream_first", "complete",
                       top=10, order=[F.desc("window.end"), F.desc("count"), "article_id"])
    return comparable(sq.flat_window(out))


# ------------------------------------------------- starting offsets (IO-05)

@register("stream_io05_starting_offsets", f"""{NEWS_SQL.replace("session_id\n  FROM", "session_id, e.ts\n  FROM")}
SELECT device_type, count(*) AS count FROM ev WHERE floor((epoch(ts) - epoch((SELECT date_trunc('day', min(ts)) FROM events))) / {86400 * LATE_DAYS}) >= {LATE_SLICES // 2} GROUP BY ALL""")
def q_stream_offsets(spark, sf_dir):
    """A query that starts at the end of a feed of fifteen days reads only
    what comes after it."""
    path = scratch_path(spark, "news-offsets")
    start = read_table(spark, sf_dir, "events").select(F.date_trunc("day", F.min("ts"))).scalar()
    keyed = news_events(spark, sf_dir, keep=("ts",))
    part = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(start)) / (86400 * LATE_DAYS)) >= LATE_SLICES // 2
    numbered = materialize(keyed.select(F.to_json(F.struct(*NEWS_FIELDS)).alias("value"), F.coalesce(part.cast("int"), F.lit(0)).alias("slice")), "news-halves")
    files = write_slices(spark, numbered, path, only=lambda i: i == 0)
    src = events_source(stream_session(spark), "text", path, maxFilesPerTrigger=files, recursiveFileLookup="true", startingOffsets="latest")
    write_slices(spark, numbered, path, files, only=lambda i: i == 1)
    return comparable(run_to_table(sq.device_trends(with_event_time(decode_events(src))), "stream_offsets", "complete"))
