"""Null handling, case rules and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_chain(df: DataFrame, out: str, *cols: str, default=None) -> DataFrame:
    """First value that is not null, then ``default``."""
    parts = [F.col(c) for c in cols] + ([] if default is None else [F.lit(default)])
    return df.withColumn(out, F.coalesce(*parts))


def case_of(df: DataFrame, rules: list[tuple[Column, object]], out: str, default=None) -> DataFrame:
    """First rule whose condition is true; a null condition falls through."""
    expr = F
    for condition, value in rules:
        expr = expr.when(condition, value if isinstance(value, Column) else F.lit(value))
    return df.withColumn(out, expr.otherwise(default if isinstance(default, Column) else F.lit(default)))


def round_to(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """Half away from zero."""
    return df.withColumns({c: F.round(F.col(c), n) for c in cols})


def percent(part: Column, whole: Column, n: int = 2) -> Column:
    """Rounded percentage; null when the whole is zero or null."""
    return F.round(F.try_divide(part * 100, whole), n)

