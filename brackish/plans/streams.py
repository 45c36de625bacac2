"""Streaming queries; the SQL states what a batch over the same table gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.plans.registry import query
from brackish.streaming import streams


def events(spark, sf):
    return streams.as_event_time(streams.table_stream(spark, sf, "events"), "ts")


def plain(df, *times):
    """Event times back to the zone-less type of the tables."""
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


@query("stream_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, sf):
    """Each (user, kind) once, with bounded state."""
    s = streams.first_seen(events(spark, sf), ["user_id", "event_type"], "ts", "40 days")
    return streams.drain(s.select("user_id", "event_type"))


@query(
    "stream_tumbling",
    """
    SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high
    FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS w FROM events) WHERE w + INTERVAL 6 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events) GROUP BY w, event_type""",
)
def stream_tumbling(spark, sf):
    """Six-hour windows per kind, emitted once final."""
    t = streams.drain(streams.tumbling(events(spark, sf), ["event_type"], "ts", "value", "6 hours", "1 hour"))
    return plain(t, "window_start", "window_end").withColumn("total", F.round("total", 4))


@query(
    "stream_sessions",
    """
    WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    g AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM s)
    SELECT min(ts) AS first, max(ts) + INTERVAL 4 HOUR AS until, user_id, count(*) AS n FROM g GROUP BY user_id, g HAVING max(ts) + INTERVAL 4 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)""",
)
def stream_sessions(spark, sf):
    """Runs of activity per user, closed by four quiet hours."""
    return plain(streams.drain(streams.sessions(events(spark, sf), ["user_id"], "ts", "4 hours", "1 hour")), "first", "until")


@query(
    "stream_time_owner",
    """
    SELECT w AS step_start, min(p).user_id AS user_id, min(p).event_id AS event_id, count(*) AS offered
    FROM (SELECT {'user_id': user_id, 'event_id': event_id} AS p, time_bucket(INTERVAL 1 HOUR, ts) AS w FROM events)
    WHERE w + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events) GROUP BY w""",
)
def stream_time_owner(spark, sf):
    """Each hour belongs to the lowest run that offers a record for it."""
    return plain(streams.drain(streams.time_owner(events(spark, sf), "ts", "1 hour", ["user_id", "event_id"], "1 hour")), "step_start")


@query(
    "stream_latest_status",
    "SELECT user_id, arg_max(event_type, (ts, event_id)) FILTER (event_id % 3 <> 0) AS stage, arg_max(value, (ts, event_id)) AS amount FROM events GROUP BY user_id",
)
def stream_latest_status(spark, sf):
    """Status table kept by batches: the last known value of each field."""
    e = events(spark, sf).select(
        "user_id", "ts", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("stage"), F.col("value").alias("amount")
    )
    return streams.drain_latest(e, ["user_id"], ["ts", "event_id"], ["stage", "amount"])
