"""Streams over several batches, with samples out of order and late, and the timer trigger."""

import datetime as dt
import time

import numpy as np
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import state, streams

T0 = dt.datetime(2024, 1, 1)


def batches(spark, rows):
    """One file per batch, read in the order written."""
    path = scratch_path(spark, "batches")
    for k, part in enumerate(rows):
        df = spark.createDataFrame([(u, T0 + dt.timedelta(seconds=s), v) for u, s, v in part], "user int, ts timestamp, v bigint")
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05 * (k < len(rows) - 1))
    return streams.read_stream(spark, path, "user int, ts timestamp, v bigint", files_per_batch=1), [x for part in rows for x in part]


ROWS = [[(1, 5, 10), (2, 3, 1)], [(1, 2, 99), (1, 9, 7)], [(2, 4, 2), (1, 9, 8)], [(3, 600, 5), (1, 590, 4)], [(1, 595, 1), (2, 1200, 3)]]


def test_latest_over_batches(spark):
    stream, rows = batches(spark, ROWS)
    got = {r["user"]: r["last_value"] for r in streams.drain_table(streams.latest_value(stream, "user", "ts", "v"), "latest", ["user"]).collect()}
    assert got == {u: max((s, v) for w, s, v in rows if w == u)[1] for u in (1, 2, 3)}


def test_trailing_over_batches(spark):
    """Closed windows of the two-second slide equal a direct count; the late row at 590 s is within the delay, state carries over."""
    stream, rows = batches(spark, ROWS)
    got = {(r["window_start"], r["user"]): (r["samples"], r["total"], r["low"], r["high"]) for r in streams.drain(streams.trailing(stream, "ts", ["user"], "v", "20 seconds", "2 seconds", "20 seconds"), "trailing").collect()}
    want = {}
    for start in range(-18, 1200, 2):
        for u in (1, 2, 3):
            own = [v for w, s, v in rows if w == u and start <= s < start + 20]
            if own and start + 20 <= 1180:
                want[T0 + dt.timedelta(seconds=start), u] = (len(own), sum(own), min(own), max(own))
    assert got == want


def test_late_rows_are_dropped(spark):
    stream, _ = batches(spark, [[(1, 0, 1)], [(1, 7200, 1)], [(1, 7250, 1)], [(1, 10, 1), (1, 7300, 1)], [(1, 20000, 1)]])
    got = {r["slot_start"]: r["n"] for r in streams.drain(streams.slot_counts(stream, "ts", ["user"], delay="1 minute"), "slots").collect()}
    assert got == {T0: 1, T0 + dt.timedelta(seconds=7200): 3}


def test_timer(spark):
    stream, rows = batches(spark, ROWS)
    out = scratch_path(spark, "timer")
    query = streams.start(stream, out, scratch_path(spark, "timer-state"), every="1 second")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(out).count() == len(rows)
    finally:
        query.stop()
    assert spark.read.parquet(out).agg(F.sum("v")).first()[0] == sum(v for _, _, v in rows)


def progress_of(df, mode):
    """Rows a stream gave, by batch, and the number of state rows after each batch."""
    got, out = [], scratch_path(df.sparkSession, "state-test")

    def take(batch, number):
        got.append([tuple(r) for r in batch.collect()])

    query = df.writeStream.outputMode(mode).option("checkpointLocation", out).foreachBatch(take).trigger(availableNow=True).start()
    query.awaitTermination()
    return got, [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_newest_keeps_state_for_a_while_only(spark):
    """An equal or older time changes nothing, a greater value at the newest time does, and keys leave the state when their time is over."""
    parts = [[(u, 10 + u, u) for u in range(50)], [(1, 11, 0), (1, 5, 99), (2, 12, 7)], [(3, 500, 1)], [(3, 1000, 2)], [(1, 2000, 5), (4, 2000, 5)], [(9, 9000, 1)]]
    stream, rows = batches(spark, parts)
    got, held = progress_of(state.newest(stream, "user", "ts", "v", keep_ms=60_000, delay="10 seconds"), "update")
    at = lambda s: T0 + dt.timedelta(seconds=s)
    shown = [r for part in got for r in part]
    assert len(shown) == 50 + 1 + 1 + 1 + 2 + 1 and (2, at(12), 7.0) in shown and (1, at(2000), 5.0) in shown and (1, at(11), 1.0) in shown
    assert max(held) >= 50 and held[-1] <= 6  # a value and a timer for each key still held
    stream, rows = batches(spark, ROWS)
    newest = {}
    for part in progress_of(state.newest(stream, "user", "ts", "v", keep_ms=10**8), "update")[0]:
        newest.update({u: (t, v) for u, t, v in part})
    assert newest == {u: max((at(s), float(v)) for w, s, v in rows if w == u) for u in (1, 2, 3)}


def test_ticks_show_the_trailing_rows(spark):
    """Every tick of every series shows exactly the samples of the span before it, late ones included, gaps and repeats too."""
    rng = np.random.default_rng(6)
    parts = [[(int(u), int(20 * k + s), int(v)) for u, s, v in zip(rng.integers(0, 3, 12), rng.integers(-15, 40, 12), rng.integers(0, 9, 12), strict=True)] for k in range(6)]
    parts += [[(1, 400, 1), (1, 400, 1), (7, 395, 2)], [(2, 1000, 3)], [(2, 1001, 3)]]
    stream, rows = batches(spark, parts)
    got, held = progress_of(state.ticks(stream, "user", "ts", "v", 20_000, 2_000, delay="1 minute"), "append")
    seen = sorted((r for part in got for r in part), key=str)
    last, want = max(s for _, s, _ in rows) - 60, []
    for tick in range(-20, last + 1, 2):
        want += [(T0 + dt.timedelta(seconds=tick), u, T0 + dt.timedelta(seconds=s), float(v)) for u, s, v in rows if tick - 20 < s <= tick]
    assert seen == sorted(want, key=str)
    assert held[-1] < max(held)
