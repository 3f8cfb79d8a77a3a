"""Feed validation and key reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import find_duplicates
from millrace.operators.quality import check, dq_report, null_profile
from millrace.operators.setops import name_diff


def feed_checks(feed: DataFrame, week: str, cols: list[str], keys: list[str], names: tuple[DataFrame, DataFrame],
                summary: DataFrame, amount: str, tolerance: float = 0.01) -> DataFrame:
    """Rows per week, nulls per column, unknown names, duplicated keys, weekly summary against detail.

    ``names`` = (feed names, master names), each with a ``name`` column; ``summary`` has (week, total).
    """
    weekly = feed.groupBy(week).agg(F.count("*").alias("n"))
    nulls = null_profile(feed, cols)
    unknown = name_diff(*names)
    dupes = find_duplicates(feed, keys).agg(F.count("*").alias("n"))
    detail = feed.groupBy(week).agg(F.sum(amount).alias("__detail"))
    gap = detail.join(summary.select(week, F.col("total").alias("__total")), week, "full_outer").withColumn(
        "gap", F.round(F.coalesce("__detail", F.lit(0)) - F.coalesce("__total", F.lit(0)), 2)
    )
    return dq_report([
        check("rows per week", weekly, F.col(week), F.col("n"), F.col("n") > 0),
        check("nulls", nulls, F.col("column_name"), F.col("n_null"), F.col("n_null") == 0),
        check("unknown names", unknown, F.concat_ws(": ", "reason", "name"), F.lit(1), F.lit(False)),
        check("duplicate keys", dupes, F.lit("all"), F.col("n"), F.col("n") == 0),
        check("summary against detail", gap, F.col(week), F.col("gap"), F.abs("gap") <= tolerance),
    ])


def reconcile_keys(a: DataFrame, b: DataFrame, parts: tuple[list[str], list[str]]) -> DataFrame:
    """Distinct composite keys in each copy and on one side only, as (measure, n).

    Both copies are reduced to their distinct keys first; one outer join of those
    answers all four questions.
    """
    keys = [f"k{i}" for i in range(len(parts[0]))]

    def distinct(df: DataFrame, cols: list[str], side: str) -> DataFrame:
        picked = df.select(*[F.col(c).alias(k) for c, k in zip(cols, keys, strict=True)]).na.drop()
        return picked.distinct().withColumn(side, F.lit(1))

    both = distinct(a, parts[0], "__a").join(distinct(b, parts[1], "__b"), keys, "full_outer")
    counts = both.agg(
        F.count("__a").alias("a"), F.count("__b").alias("b"),
        F.count_if(F.col("__b").isNull()).alias("only_a"), F.count_if(F.col("__a").isNull()).alias("only_b"),
    )
    lines = [("distinct keys in first", "a"), ("distinct keys in second", "b"), ("missing from second", "only_a"), ("missing from first", "only_b")]
    return counts.select(F.inline(F.array(*[F.struct(F.lit(t).alias("measure"), F.col(c).alias("n")) for t, c in lines])))
