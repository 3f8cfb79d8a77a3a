"""Session settings, lineage cuts and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime (non-static) settings every job in this package relies on: AQE picks
# join strategies from measured sizes and splits skewed partitions even when
# that costs another shuffle further up. Files are taken for eight times their
# length, as compressed columns are rows of many times that where a side is
# broadcast: a file of a few megabytes would fill the driver. Shuffle files go
# when their job is over, not when the driver happens to collect its garbage.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "8.0",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "millrace", master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with the package settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    # Call-site capture costs a stack walk per column expression, which wide plans feel.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = named or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    current = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


_PASSING: list[list[str]] = []  # folders kept in the blocks now open, the innermost last


def kept(df: DataFrame, label: str = "kept", stays: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Smaller than a pinned frame, read by column, and of known size, so that a small one is broadcast from the start. Partitions are not kept: ``pin`` does that.
    Inside ``passing`` the files go with the block, or with ``stays`` with the block around it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    for block in _PASSING[:-1][-1:] if stays else _PASSING[-1:]:
        block.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is kept inside: for a step whose result is written by then, so that no later frame reads them."""
    _PASSING.append([])
    try:
        yield
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, _PASSING.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once so later reads see the same rows in the same partitions."""
    shared_dir(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
