"""Structured Streaming counterparts: metric samples, slots, sessions, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from millrace.session import scratch_path


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def as_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def parse_sample(df: DataFrame, member: str = "member", epoch_ms: str = "score") -> DataFrame:
    """``cpu:mem`` text and epoch milliseconds to (ts, cpu, mem, cpu_whole, mem_whole)."""
    parts = F.split(F.col(member), ":")
    cpu, mem = (F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1))
    return df.select(
        F.timestamp_millis(epoch_ms).alias("ts"), cpu.alias("cpu"), mem.alias("mem"),
        cpu.try_cast("int").alias("cpu_whole"), mem.try_cast("int").alias("mem_whole"),
    )


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """A folder of (member, score) JSON lines as a stream of samples."""
    schema = T.StructType([T.StructField("member", T.StringType()), T.StructField("score", T.LongType())])
    return parse_sample(read_stream(spark, path, schema, "json"))


def trailing(df: DataFrame, ts: str, keys: list[str], value: str, length: str = "5 minutes", slide: str = "2 seconds",
             delay: str = "10 seconds") -> DataFrame:
    """History of the last ``length``, renewed every ``slide``: samples, sum, low and high per sliding window.

    Two levels: samples are summed into spans of one ``slide`` first, and only those, one per series and span, are copied
    into the windows that hold them; ``length`` is a multiple of ``slide``. Works on a stream (with watermark) and on a
    batch frame (watermark ignored).
    """
    marked = df.withWatermark(ts, delay) if df.isStreaming else df
    spans = marked.groupBy(F.window(ts, slide).alias("__p"), *keys).agg(
        F.count("*").alias("samples"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    return (
        spans.groupBy(F.window("__p" if df.isStreaming else F.col("__p.start"), length, slide).alias("__w"), *keys)
        .agg(F.sum("samples").alias("samples"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
        .select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *keys, "samples", "total", "low", "high")
    )


def trailing_rows(df: DataFrame, ts: str, seconds: int = 300, now=None) -> DataFrame:
    """The samples of the last ``seconds`` before ``now`` (default: the newest sample), both ends included."""
    mark = df.agg(F.max(ts)).scalar() if now is None else F.lit(now).cast("timestamp")
    return df.filter((F.col(ts) >= mark - F.make_dt_interval(secs=F.lit(seconds))) & (F.col(ts) <= mark))


def latest_value(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Newest value per series; equal times go to the greater value."""
    return df.groupBy(key).agg(F.max(F.struct(ts, value)).alias("__last")).select(
        key, F.col(f"__last.{ts}").alias("last_ts"), F.col(f"__last.{value}").alias("last_value")
    )


def upsert_member(df: DataFrame, member: str, ts: str, collapse: bool = True) -> DataFrame:
    """Sorted-set write: an equal member is kept once with its newest time. ``collapse=False`` keeps every reading."""
    return df.groupBy(member).agg(F.max(ts).alias(ts)) if collapse else df.select(member, ts)


def slot_counts(df: DataFrame, ts: str, keys: list[str], length: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    marked = df.withWatermark(ts, delay) if df.isStreaming else df
    return (
        marked.groupBy(F.window(ts, length).alias("__w"), *keys).agg(F.count("*").alias("n"))
        .select(F.col("__w.start").alias("slot_start"), F.col("__w.end").alias("slot_end"), *keys, "n")
    )


def session_stream(df: DataFrame, keys: list[str], ts: str, gap: str, delay: str = "1 hour") -> DataFrame:
    marked = df.withWatermark(ts, delay) if df.isStreaming else df
    return (
        marked.groupBy(F.session_window(ts, gap).alias("__w"), *keys).agg(F.count("*").alias("signals"))
        .select(F.col("__w.start").alias("start_time"), F.col("__w.end").alias("end_time"), *keys, "signals")
    )


def dedup_stream(df: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def start(df: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = "2 seconds",
          available_now: bool = False) -> StreamingQuery:
    """Write a stream to parquet on a timer, or once over what is there."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).format("parquet").option("path", path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def drain(df: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream over everything available and return what it wrote."""
    spark = df.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    start(df, out, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def drain_table(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Run an update-mode stream over everything available and return the newest row of each key.

    A batch writes only the rows it changed, into a folder of its number: a batch run again replaces its own folder, and what
    readers see is never taken away.
    """
    spark = df.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-state")

    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(publish).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    changes = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), "batch").alias("__row"))
    return newest.select("__row.*")
