"""The registered queries of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import audit, contamination, language, lines, minhash, mixing, packing, pages, rules, secrets, spelling, tokenfiles, toxicity
from millrace.llm.tables import store, table

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    of = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("bigint")
    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.concat("base", "linked")).alias("spans"),
    )


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))


@query
def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), store).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = tokenfiles.write(table(spark, sf_dir, "documents"))
    return tokenfiles.read(written).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op13_interactions"] = audit.INTERACTIONS_SQL
