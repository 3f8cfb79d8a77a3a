"""The corpus pipeline: quality rules, near duplicates, decontamination, secrets, packing, one table written and read again per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import contamination, minhash, packing, rules, secrets
from millrace.llm.tables import store, table

SIMILARITY = 80  # percent of shared 5-word shingles from which two documents are one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and every certified cutoff."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"), store)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group; of rows equal in doc_id and text, one. Rows with a null doc_id stay."""
    judged = minhash.near_duplicates(docs, SIMILARITY)
    rows = docs.select("doc_id", F.xxhash64("text").alias("code"), F.md5("text").alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    stay = rows.join(judged.where("kept and doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    once = Window.partitionBy("doc_id", "code", "digest").orderBy("doc_id")
    stay = stay.withColumn("copy", F.row_number().over(once)).where("copy = 1").select("row.*")
    return stay.unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows with a null doc_id cannot be reported and stay."""
    found = contamination.contained_items(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; n_chars follows the text."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents cut into sequences: one row per piece."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", decontaminate), ("secrets", mask_secrets), ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
