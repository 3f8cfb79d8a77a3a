"""Data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: list[str], null_word: str = "null") -> DataFrame:
    """Per column: rows, nulls, rows an ``= NULL`` test finds (always none) and rows holding the word 'null'.

    One aggregate over the table; its single row is then turned into one row per column.
    """
    aggs: list[Column] = [F.count("*").alias("__rows")]
    for i, c in enumerate(cols):
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"__n{i}"),
            F.count_if(F.coalesce(F.col(c) == F.lit(None), F.lit(False))).alias(f"__e{i}"),
            F.count_if(F.coalesce(F.col(c).cast("string") == null_word, F.lit(False))).alias(f"__t{i}"),
        ]
    lines = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("n_rows"), F.col(f"__n{i}").alias("n_null"),
                 F.col(f"__e{i}").alias("n_equal_null"), F.col(f"__t{i}").alias("n_null_text"))
        for i, c in enumerate(cols)
    ])
    return df.agg(*aggs).select(F.inline(lines))


def check(name: str, found: DataFrame, key: Column, value: Column, passed: Column) -> DataFrame:
    """Bring one check's result to the report shape."""
    return found.select(
        F.lit(name).alias("check_name"), key.cast("string").alias("check_key"),
        value.cast("double").alias("check_value"), F.when(passed, 1).otherwise(0).alias("passed"),
    )


def dq_report(checks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)
