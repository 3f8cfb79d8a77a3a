"""Set operations on frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common_values(a: DataFrame, a_col: str, b: DataFrame, b_col: str, out: str = "value") -> DataFrame:
    """Distinct values present on both sides."""
    return a.select(F.col(a_col).alias(out)).intersect(b.select(F.col(b_col).alias(out)))


def all_values(a: DataFrame, a_col: str, b: DataFrame, b_col: str, out: str = "value") -> DataFrame:
    """Distinct values present on either side."""
    return a.select(F.col(a_col).alias(out)).unionByName(b.select(F.col(b_col).alias(out))).distinct()


def name_diff(feed: DataFrame, master: DataFrame, col: str = "name",
              reasons: tuple[str, str] = ("not in master", "not in feed")) -> DataFrame:
    """Distinct names on one side only, each with the side it is missing from."""
    a = feed.select(col).where(F.col(col).isNotNull()).distinct().withColumn("__in_feed", F.lit(1))
    b = master.select(col).where(F.col(col).isNotNull()).distinct().withColumn("__in_master", F.lit(1))
    both = a.join(b, col, "full_outer")
    reason = F.when(F.col("__in_master").isNull(), reasons[0]).when(F.col("__in_feed").isNull(), reasons[1])
    return both.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(col, "reason")
