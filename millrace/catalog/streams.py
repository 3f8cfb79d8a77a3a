"""Streaming queries over ``events``, each run once over everything available.

A window leaves an append-mode stream when the watermark (newest time minus the
allowed delay) has passed its end, so the SQL side keeps closed windows only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import query, table
from millrace.streaming import state, streams


def _events(spark, sf):
    # As a glob, because a streaming source takes a single file only that way.
    path = f"{sf}/events.parque[t]"
    return streams.as_event_time(streams.read_stream(spark, path, table(spark, sf, "events").schema), "ts")


def _wall(df):
    """Timestamps without zone, as the SQL side has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query(f"""
SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS slot_start, time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS slot_end, event_type, count(*) AS n FROM events
WHERE time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE <= {CLOSED} GROUP BY ALL""")
def stream_slots(spark, sf):
    return _wall(streams.drain(streams.slot_counts(_events(spark, sf), "ts", ["event_type"]), "slots"))


@query(f"""
WITH m AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 2 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM m)
SELECT user_id, min(ts) AS start_time, max(ts) + INTERVAL 2 HOUR AS end_time, count(*) AS signals FROM g GROUP BY user_id, s HAVING max(ts) + INTERVAL 2 HOUR <= {CLOSED}""")
def stream_sessions(spark, sf):
    return _wall(streams.drain(streams.session_stream(_events(spark, sf), ["user_id"], "ts", "2 hours"), "sessions"))


@query("SELECT user_id, max(ts) AS last_ts, arg_max(value, (ts, value)) AS last_value FROM events GROUP BY 1")
def stream_latest(spark, sf):
    return _wall(streams.drain_table(streams.latest_value(_events(spark, sf), "user_id", "ts", "value"), "latest", ["user_id"]))


@query("""
WITH e AS (SELECT ts, event_type, CAST(floor(value) AS BIGINT) AS v FROM events),
s AS (SELECT unnest([0, 1, 2, 3, 4]) AS k),
w AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS window_start, event_type, v FROM e, s)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS samples, CAST(sum(v) AS BIGINT) AS total, min(v) AS low, max(v) AS high FROM w
WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events) GROUP BY ALL""")
def stream_trailing(spark, sf):
    e = _events(spark, sf).withColumn("v", F.floor("value"))
    return _wall(streams.drain(streams.trailing(e, "ts", ["event_type"], "v", "5 minutes", "1 minute"), "trailing"))


@query("SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 300 SECOND")
def trailing_now(spark, sf):
    """The last five minutes before the newest sample."""
    return streams.trailing_rows(table(spark, sf, "events").select("event_id", "ts"), "ts")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf):
    """Every signal arrives twice; one copy is kept."""
    e = _events(spark, sf)
    out = streams.dedup_stream(e.union(_events(spark, sf)), ["event_id"], "ts")
    return streams.drain(out.select("event_id", "user_id", "event_type"), "dedup")


@query("SELECT CAST(user_id AS VARCHAR) || ':' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS member, max(ts) AS ts FROM events GROUP BY 1")
def stream_upsert(spark, sf):
    e = _events(spark, sf).select(F.concat_ws(":", F.col("user_id").cast("string"), F.floor("value").cast("string")).alias("member"), "ts")
    return _wall(streams.drain_table(streams.upsert_member(e, "member", "ts"), "upsert", ["member"]))


@query("""
SELECT make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, CAST(user_id AS DOUBLE) AS cpu, value AS mem, CAST(user_id AS INTEGER) AS cpu_whole, CAST(trunc(value) AS INTEGER) AS mem_whole FROM events""")
def stream_samples(spark, sf):
    """``cpu:mem`` texts written as JSON lines, then read as a stream of samples."""
    from millrace.session import scratch_path

    path = scratch_path(spark, "samples")
    table(spark, sf, "events").select(
        F.concat_ws(":", F.col("user_id").cast("string"), F.col("value").cast("string")).alias("member"), F.unix_millis(F.col("ts").cast("timestamp")).alias("score")
    ).write.json(path)
    return _wall(streams.drain(streams.read_samples(spark, path), "parsed"))


@query("SELECT user_id, max(ts) AS last_ts, arg_max(value, (ts, value)) AS last_value FROM events GROUP BY 1")
def stream_newest(spark, sf):
    """Newest value per series from state that a series leaves a day after its last sample."""
    return _wall(streams.drain_table(state.newest(_events(spark, sf), "user_id", "ts", "value", 24 * 3_600_000), "newest", ["user_id"]))


@query("""
WITH s AS (SELECT unnest([0, 1, 2, 3, 4]) AS k),
t AS (SELECT make_timestamp((epoch_us(ts) + 59999999) // 60000000 * 60000000) + k * INTERVAL 1 MINUTE AS tick, event_type, ts, value FROM events, s)
SELECT tick, event_type, ts, value FROM t WHERE ts > tick - INTERVAL 5 MINUTE AND tick <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events)""")
def stream_ticks(spark, sf):
    """The samples of the last five minutes, shown every minute."""
    return _wall(streams.drain(state.ticks(_events(spark, sf), "event_type", "ts", "value", 300_000, 60_000), "ticks"))
