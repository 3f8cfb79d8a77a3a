"""Reading the given tables and keeping intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: later uses neither recompute it nor lose it with an executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(column: str, folds: int) -> Column:
    """crc32 of the value as text modulo ``folds``; a null value counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, left_out: int, per_class: int) -> list[tuple[str, int]]:
    """(text, 0 or 1) of at most ``per_class`` labelled documents of each class outside fold ``left_out``, chosen and ordered by a hash of doc_id.

    A doc_id with several labels counts by the highest, with several texts by the first in order; null ids, labels and texts are passed over.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(label).alias("y"))
    known = known.where(fold("doc_id", folds) != left_out)
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])  # at most 2 * per_class rows of two numbers
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where("text is not null").join(F.broadcast(ids), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    return [(r["text"], int(r["y"])) for r in one.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
