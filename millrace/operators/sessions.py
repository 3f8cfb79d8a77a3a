"""Sessions: signals of one key joined while the pause between them stays short."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import micros
from millrace.operators.ranges import max_before


def sessionize(df: DataFrame, keys: list[str], ts: str, dur: str | None, gap: int, hours: int = 6) -> DataFrame:
    """One row per session: keys, start_time, end_time, signals, watch_seconds, duration.

    A signal covers ``[ts, ts + dur seconds)``; it opens a session when it starts
    more than ``gap`` seconds after every earlier signal of the key has ended.
    Signals are first reduced to one row per (keys, ts); the rest is a scan split
    into ``hours``-wide buckets, so a hot key is worked on by many tasks.
    """
    length = F.col(dur).cast("long") if dur else F.lit(0).cast("long")
    at = micros(F.col(ts))
    dots = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, at.alias("__at"))
        .agg(
            F.max(at + F.coalesce(length, F.lit(0)) * 1_000_000).alias("__end"),
            F.count("*").alias("__signals"),
            F.sum(F.coalesce(length, F.lit(0))).alias("__watch"),
        )
        .withColumn("__bucket", F.floor(F.col("__at") / F.lit(hours * 3_600_000_000)))
    )
    seen = max_before(dots, keys, "__bucket", "__at", "__end", "__prev_end")
    opens = F.col("__prev_end").isNull() | (F.col("__at") > F.col("__prev_end") + gap * 1_000_000)
    marked = seen.withColumn("__opened", F.when(opens, F.col("__at")))
    placed = max_before(marked, keys, "__bucket", "__at", "__opened", "__start", strict=False)
    out = placed.groupBy(*keys, "__start").agg(
        F.max("__end").alias("__stop"), F.sum("__signals").alias("signals"), F.sum("__watch").alias("watch_seconds")
    )
    return out.select(
        *keys,
        F.timestamp_micros("__start").cast("timestamp_ntz").alias("start_time"),
        F.timestamp_micros("__stop").cast("timestamp_ntz").alias("end_time"),
        "signals",
        "watch_seconds",
        F.floor((F.col("__stop") - F.col("__start")) / 1_000_000).alias("duration"),
    )
