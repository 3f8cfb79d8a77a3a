"""Keyed stream state that leaves again: newest value per key with an expiry, and the rows of a trailing span at every tick.

Both keep their state in a RocksDB store and are driven by event-time timers, so what is held is bounded by the keys and samples of the time
kept, however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROWS_OUT = 10_000  # rows a processor hands over at once, or those of one tick if they are more
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Timers and state variables need this store; streams started from now on use it."""
    spark.conf.set(PROVIDER, ROCKSDB)


# Row names must not begin with an underscore: the frames handed to a processor would lose them.


class Newest(StatefulProcessor):
    """State per key: newest time and its value; cleared ``keep_ms`` after that time."""

    def __init__(self, keep_ms: int) -> None:
        self._keep_ms = keep_ms

    def init(self, handle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "us long, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._last.get() if self._last.exists() else None
        best = None if held is None else (held[0], held[1])
        for frame in rows:
            for us, value in zip(frame["at_us"].tolist(), frame["number"].tolist()):
                best = (us, value) if best is None or (us, value) > best else best
        if held is None or best != tuple(held):
            if held is None or best[0] != held[0]:
                if held is not None:
                    self._handle.deleteTimer(held[0] // 1000 + self._keep_ms)
                self._handle.registerTimer(best[0] // 1000 + self._keep_ms)
            self._last.update(best)
            yield pd.DataFrame({"series": [key[0]], "at_us": [best[0]], "number": [best[1]]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._last.clear()
        yield from ()

    def close(self) -> None:
        pass


def newest(df: DataFrame, key: str, ts: str, value: str | None, keep_ms: int, delay: str = "1 hour") -> DataFrame:
    """Update-mode stream of (``key``, last_ts, last_value): a row whenever the newest time of a key, or the greatest value at it, changes.

    A key leaves the state when the watermark has passed its newest time by ``keep_ms``; seen again later it starts anew. ``value`` is read as a double;
    without one the result has no last_value. Rows with a null time or key are left out.
    """
    use_rocksdb(df.sparkSession)
    rows = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    number = F.lit(0.0) if value is None else F.coalesce(F.col(value).cast("double"), F.lit(float("-inf")))
    rows = rows.select(F.col(key).cast("string").alias("series"), F.col(ts).alias("event_time"), F.unix_micros(ts).alias("at_us"), number.alias("number")).withWatermark("event_time", delay)
    found = rows.groupBy("series").transformWithStateInPandas(Newest(keep_ms), "series string, at_us long, number double", "Update", "EventTime")
    out = [F.col("series").cast(df.schema[key].dataType).alias(key), F.timestamp_micros("at_us").alias("last_ts")]
    return found.select(*out, *([F.nullif("number", F.lit(float("-inf"))).alias("last_value")] if value else []))


class Ticks(StatefulProcessor):
    """State per series and block of ticks: the samples that ticks of the block to come may show, packed, and the time of the next tick."""

    def __init__(self, length_ms: int, every_ms: int, span_ms: int) -> None:
        self._length, self._every, self._span = length_ms * 1000, every_ms * 1000, span_ms * 1000  # in microseconds like the samples

    def init(self, handle) -> None:
        self._handle = handle
        self._samples = handle.getListState("samples", "us binary, numbers binary")
        self._next = handle.getValueState("next", "us long")

    def _keep(self, us: np.ndarray, numbers: np.ndarray) -> tuple[bytes, bytes]:
        return us.astype("<i8").tobytes(), numbers.astype("<f8").tobytes()

    def _first_tick(self, us: int, block: int) -> int:
        return max(-(-us // self._every) * self._every, block * self._span)

    def _schedule(self, tick: int) -> None:
        due = self._next.get()[0] if self._next.exists() else None
        if due is not None and due <= tick:
            return
        if due is not None:
            self._handle.deleteTimer(due // 1000)
        self._next.update((tick,))
        self._handle.registerTimer(tick // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            us = frame["at_us"].to_numpy()
            self._samples.appendValue(self._keep(us, frame["number"].to_numpy()))
            self._schedule(self._first_tick(int(us.min()), int(key[1])))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tick, mark = expiredTimerInfo.getExpiryTimeInMs() * 1000, timerValues.getCurrentWatermarkInMs() * 1000
        held = [(np.frombuffer(us, "<i8"), np.frombuffer(numbers, "<f8")) for us, numbers in self._samples.get()]
        us, numbers = (np.concatenate(part) for part in zip(*held, strict=True))
        order = np.argsort(us, kind="stable")
        us, numbers = us[order], numbers[order]
        end = (int(key[1]) + 1) * self._span
        due = np.arange(tick, min(mark + 1, end), self._every)
        low, high = np.searchsorted(us, due - self._length, "right"), np.searchsorted(us, due, "right")
        # Ticks go out some thousand rows at a time.
        done, shown = np.r_[0, np.cumsum(high - low)], 0
        while shown < len(due):
            upto = max(shown + 1, int(np.searchsorted(done, done[shown] + ROWS_OUT, "right")) - 1)
            each = high[shown:upto] - low[shown:upto]
            at = np.arange(each.sum()) + np.repeat(low[shown:upto] - (np.cumsum(each) - each), each)
            if len(at):
                yield pd.DataFrame({"tick_us": np.repeat(due[shown:upto], each), "series": key[0], "at_us": us[at], "number": numbers[at]})
            shown = upto
        self._next.clear()
        self._samples.clear()
        tick += len(due) * self._every
        left = np.searchsorted(us, tick - self._length, "right")
        if left < len(us) and (tick := max(tick, self._first_tick(int(us[left]), int(key[1])))) < end:
            self._samples.put([self._keep(us[left:], numbers[left:])])
            self._schedule(tick)

    def close(self) -> None:
        pass


def ticks(df: DataFrame, key: str, ts: str, value: str, length_ms: int = 300_000, every_ms: int = 2_000, delay: str = "10 seconds") -> DataFrame:
    """Append-mode stream of the rows each tick shows: (tick, ``key``, ``ts``, ``value``), the samples of the ``length_ms`` up to it, its own time included.

    Ticks are the multiples of ``every_ms``; one comes out when the watermark has passed it, so late samples within ``delay`` are in it. A series without
    samples in the span has no rows. The state holds the samples of one span and delay. ``value`` is read as a double; null times, keys and values are left out.

    State is kept by series and block of ticks, twelve times ``length_ms`` long: a sample near the end of a block is copied into the next, so that a
    series that holds a fifth of the table is still the work of many groups and none holds more than a block of it.
    """
    use_rocksdb(df.sparkSession)
    rows = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull())
    rows = rows.select(F.col(key).cast("string").alias("series"), F.col(ts).alias("event_time"), F.unix_micros(ts).alias("at_us"), F.col(value).cast("double").alias("number")).withWatermark("event_time", delay)
    every, per_block = every_ms * 1000, -(-12 * length_ms // every_ms)

    def whole(number: str, by: int) -> str:
        return f"(({number}) - pmod({number}, {by}L)) div {by}L"

    # The numbers of the ticks that show a sample: from the first at or after its time to the last before it leaves.
    first, last = f"({whole('at_us - 1', every)} + 1)", f"({whole(f'at_us + {length_ms * 1000 - 1}L', every)})"
    rows = rows.filter(f"{first} <= {last}").withColumn("block", F.expr(f"explode(sequence({whole(first, per_block)}, {whole(last, per_block)}))"))
    found = rows.groupBy("series", "block").transformWithStateInPandas(Ticks(length_ms, every_ms, per_block * every_ms), "tick_us long, series string, at_us long, number double", "Append", "EventTime")
    return found.select(
        F.timestamp_micros("tick_us").alias("tick"), F.col("series").cast(df.schema[key].dataType).alias(key), F.timestamp_micros("at_us").alias(ts), F.col("number").alias(value)
    )
