"""Catalog tables, databases, incremental reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shape import conform


def read_db(spark: SparkSession, url: str, query: str, bounds: tuple[str, object, object, int] | None = None,
            properties: dict[str, str] | None = None) -> DataFrame:
    """A database query as a frame. ``bounds`` = (column, low, high, tasks) reads it in parallel ranges;
    without it one task reads everything, so give it for anything large."""
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if bounds is None:
        return reader.option("query", query).load()
    column, low, high, tasks = bounds
    return (
        reader.option("dbtable", f"({query}) q").option("partitionColumn", column)
        .option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", tasks).load()
    )


def append_db(df: DataFrame, schema: T.StructType, url: str, table: str, batch: int = 30_000,
              properties: dict[str, str] | None = None) -> None:
    writer = conform(df, schema).write.format("jdbc").option("url", url).option("dbtable", table)
    writer.option("batchsize", batch).options(**(properties or {})).mode("append").save()


def load_subjects(spark: SparkSession, sources: dict[str, str | DataFrame], tag: str = "lob", fmt: str = "parquet") -> DataFrame:
    """Several subject tables as one, each row tagged with its subject; missing columns are null."""
    frames = [
        (src if isinstance(src, DataFrame) else spark.read.format(fmt).load(src)).withColumn(tag, F.lit(name))
        for name, src in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def materialise(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None, parts: list[str] = ()) -> DataFrame:
    """Drop and re-create table ``name`` from ``df``; with ``path`` its files live there."""
    writer = df.write.format(fmt).mode("overwrite")
    writer = writer.partitionBy(*parts) if parts else writer
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def insert_dynamic(df: DataFrame, table: str) -> None:
    """Append into a partitioned table; partition values come from the rows, columns match by position."""
    df.write.mode("append").insertInto(table)


def append(df: DataFrame, schema: T.StructType, path: str, fmt: str = "parquet") -> None:
    """Typed append to a folder."""
    conform(df, schema).write.format(fmt).mode("append").save(path)


def incremental(df: DataFrame, target: DataFrame, ts_col: str, lookback_days: int = 0, target_col: str | None = None) -> DataFrame:
    """Rows of ``df`` after the newest ``ts_col`` in ``target`` minus ``lookback_days``; all rows, null times too, when target is empty or has no times.

    The mark is a scalar subquery, so the comparison reaches the scan of ``df``. Without a mark every time passes, and only then do null times.
    """
    mark = F.max(target_col or ts_col)
    low = F.date_sub(mark, lookback_days) if lookback_days else mark
    first = F.lit("0001-01-01").cast(df.schema[ts_col].dataType)
    since, unmarked = target.agg(F.coalesce(low, first)).scalar(), target.agg(mark.isNull()).scalar()
    return df.filter((F.col(ts_col) > since) | (F.col(ts_col).isNull() & unmarked))
