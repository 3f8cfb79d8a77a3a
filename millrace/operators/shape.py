"""Column shaping: renames, typed conformance, sentinels, view registration."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import ascii_fold, date_in, number_in


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def normal_name(name: str, width: int | None = 30) -> str:
    return name.replace(" ", "_")[:width].upper()


def normalise_names(df: DataFrame, width: int | None = 30) -> DataFrame:
    """Blanks to underscores, cut to ``width``, upper case; two columns must not end up with one name."""
    names = [normal_name(c, width) for c in df.columns]
    clashes = [n for n, k in Counter(names).items() if k > 1]
    if clashes:
        raise ValueError(f"column names collide after shortening: {clashes}")
    return df.toDF(*names)


def conform(df: DataFrame, schema: T.StructType, fold: bool = True) -> DataFrame:
    """Project ``df`` onto ``schema`` by name, driven by each declared type.

    Text is folded to ASCII; numbers are the first number in the text; dates the
    first date in the text. A column the input lacks becomes a typed null.
    ``fold=False`` is for text that is ASCII already.
    """
    spelled = {c.upper(): c for c in df.columns}
    wanted = {spelled[f.name.upper()] for f in schema.fields if f.name.upper() in spelled}
    texts = [c for c, t in df.dtypes if t == "string" and c in wanted]
    source = ascii_fold(df, texts) if fold else df
    kinds = {c.upper(): t for c, t in df.dtypes}
    out = []
    for field in schema.fields:
        name, key = field.name, field.name.upper()
        if key not in spelled:
            out.append(F.lit(None).cast(field.dataType).alias(name))
            continue
        col, is_text = F.col(f"`{spelled[key]}`"), kinds[key] == "string"
        if is_text and isinstance(field.dataType, T.DateType):
            col = date_in(col)
        elif is_text and isinstance(field.dataType, T.NumericType):
            col = number_in(col)
        out.append((col.try_cast(field.dataType) if is_text else col.cast(field.dataType)).alias(name))
    return source.select(*out)


def null_if(df: DataFrame, cols: list[str], sentinel) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in cols})


def cast_all(df: DataFrame, casts: dict[str, str], strict: bool = False) -> DataFrame:
    """Typed columns; a value that does not fit becomes null, or stops the job if ``strict``."""
    return df.withColumns({c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in casts.items()})


def constants(df: DataFrame, values: dict[str, object], types: dict[str, str] | None = None) -> DataFrame:
    """Constant columns; a null needs its type named in ``types``."""
    types = types or {}
    return df.withColumns({k: F.lit(v).cast(types[k]) if k in types else F.lit(v) for k, v in values.items()})


def dim(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A literal lookup table. Its size is the length of the list in the code."""
    return spark.createDataFrame(rows, schema)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df
