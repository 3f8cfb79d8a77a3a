"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects a document whose rate reaches a cutoff. Candidate cutoffs are fixed beforehand. On labelled documents of a length
stratum, a cutoff with k of n good documents rejected is certified if P(Bin(n, risk) <= k) <= level / tests, the exact binomial bound. The
cutoffs of a rule in a stratum are tested in a fixed order, the mildest first, up to the first that fails, so they need no correction among
themselves; Bonferroni's correction covers the rules and strata. The last cutoff certified applies; a rule without one rejects nothing.
So with confidence 1 - level, no rule rejects more than its share of the risk of the good documents of any stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS, UPPER = "[#*$%&|<>]", "[A-Z]"
RISK, LEVEL = 0.05, 0.05  # of all rules together
LEAST_WORDS, MOST_REPEATED = 50, 50
STRATA = (100, 400, 1600)  # word counts at which a new stratum begins
CUTOFFS = tuple(k / 20 for k in range(1, 21))  # of each rule's rate
RULES = ("symbol_rate", "bang_rate", "upper_rate", "dup_line_rate", "repeat_rate")


def _count(text: Column, kind: str) -> Column:
    return F.regexp_count(text, F.lit(kind)).cast("bigint")


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with one struct column ``q`` of the statistics; computed step by step so that no array is built twice."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.trim(F.col("q_text"), F.lit(SPACES))
    step = docs.withColumn("q_text", text)
    step = step.withColumn("q_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+")))
    # 3-word windows by hash. Only a text in which one comes twice has its windows sorted, to find equal neighbours and their places.
    words, windows = F.col("q_words"), F.col("q_windows")
    n = F.size(words)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    step = step.withColumn("q_windows", F.when(n >= 4, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), window)).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    step = step.withColumn("q_sorted", F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))
    at = F.col("q_sorted")
    hit = F.filter(at, lambda x, i: (x["h"] == F.get(at, i - 1)["h"]) | (x["h"] == F.get(at, i + 1)["h"]))
    step = step.withColumn("q_hits", F.sort_array(F.transform(hit, lambda x: x["p"])))
    step = step.withColumn("q_lines", F.filter(F.split("q_text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != ""))
    hits, lines = F.col("q_hits"), F.col("q_lines")
    covered = F.aggregate(
        hits, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-9).alias("end")),
        lambda a, p: F.struct((a["n"] + (p + 3 - F.greatest(p, a["end"]))).cast("bigint").alias("n"), (p + 3).alias("end")), lambda a: a["n"],
    )
    whole = F.col("q_text")
    return step.withColumn("q", F.struct(
        F.size("q_words").cast("bigint").alias("n_words"), F.char_length(F.array_join("q_words", "")).cast("bigint").alias("word_chars"),
        _count(whole, SYMBOLS).alias("n_symbols"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.size(lines).cast("bigint").alias("n_lines"), _count(whole, "!").alias("n_bangs"),
        _count(whole, UPPER).alias("n_upper"),
    )).drop("q_text", "q_words", "q_windows", "q_sorted", "q_hits", "q_lines")


def _ratio(a: Column, b: Column) -> Column:
    return F.least(a / F.greatest(b, F.lit(1)), F.lit(1.0))


def rates() -> dict[str, Column]:
    q = F.col("q")
    return {
        "symbol_rate": _ratio(q["n_symbols"], q["n_words"]), "bang_rate": _ratio(q["n_bangs"], q["n_words"]), "upper_rate": _ratio(q["n_upper"], q["word_chars"]),
        "dup_line_rate": _ratio(q["n_dup_lines"], q["n_lines"]), "repeat_rate": _ratio(q["n_repeat_words"], q["n_words"]),
    }


def stratum() -> Column:
    n = F.col("q")["n_words"]
    return sum(((n >= limit).cast("int") for limit in STRATA), F.lit(0))


def base_failed() -> Column:
    q = F.col("q")
    return (q["n_words"] < LEAST_WORDS) | (q["n_repeat_words"] * 100 > q["n_words"] * MOST_REPEATED)


def _log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 9, taken back by the product (x+1)…(x+8); error below 1e-13."""
    y, back = x + 9.0, F.lit(1.0)
    for k in range(1, 9):
        back = back * (x + float(k))
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(back)


def binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k): the term at k, from logarithms, times the sum of ratios of the terms below it."""
    n, k = n.cast("double"), F.least(k, n).cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    odds = (1 - p) / p
    ratios = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), F.greatest(k, F.lit(1.0)).cast("bigint")), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (k - j + 1) / (n - k + j) * odds).alias("term"), (a["sum"] + a["term"] * F.greatest(k - j + 1, F.lit(0.0)) / (n - k + j) * odds).alias("sum"),
        ), lambda a: a["sum"],
    )
    return F.least(F.when(k >= n, F.lit(1.0)).otherwise(top * ratios), F.lit(1.0))


def calibrate(measured: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Certified cutoffs (stratum, rule, cutoff), at most one per stratum and rule, from documents labelled good.

    ``measured`` has doc_id and q. Rows that fail the base rules are outside the guarantee and not counted. Labels of null quality or
    null doc_id are ignored; a doc_id with several labels counts by the lowest. Without labels nothing is certified.
    """
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    tests = len(RULES) * (len(STRATA) + 1)
    held = measured.where(~base_failed()).select("doc_id", stratum().alias("stratum"), *[c.alias(r) for r, c in rates().items()]).join(good, "doc_id", "left_semi")
    # One pass: rates fall on the fixed grid, so each (stratum, rule) has at most as many groups as cutoffs.
    long = held.select("stratum", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.floor(F.col(r) * 20 + 1e-9).alias("reach")) for r in RULES])).alias("x"))
    counts = long.groupBy("stratum", "x.rule").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("x.reach") >= k).alias(f"k{k}") for k in range(1, len(CUTOFFS) + 1)]
    )
    tried = counts.select("stratum", "rule", "n", F.explode(F.array(*[F.struct(F.lit(c).alias("cutoff"), F.lit(k + 1).alias("reach"), F.col(f"k{k + 1}").alias("k")) for k, c in enumerate(CUTOFFS)])).alias("t"))
    # A lower cutoff rejects all that a higher one does, of the same n, so its bound is no smaller: all before the lowest that passes pass too.
    certified = tried.where(binomial_cdf(F.col("n"), F.col("t.k"), risk / len(RULES)) <= level / tests)
    return certified.groupBy("stratum", "rule").agg(F.min("t.reach").alias("reach"), F.min("t.cutoff").alias("cutoff"))


def verdict(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept. The cutoffs, at most one per stratum and rule, reach the plan as one scalar map."""
    found = cutoffs.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "stratum", "rule"), F.col("reach").cast("int")))).alias("m")).scalar()
    reached = F.lit(False)
    for rule, rate in rates().items():
        limit = F.get(F.array(F.element_at(F.col("q_cutoffs"), F.concat_ws(":", stratum(), F.lit(rule)))), F.lit(0))
        reached = reached | F.coalesce(F.floor(rate * 20 + 1e-9) >= limit, F.lit(False))
    failed = base_failed()
    return measured.withColumn("q_cutoffs", found).withColumns({"base_failed": failed, "kept": ~failed & ~reached}).drop("q_cutoffs")


def quality(docs: DataFrame, labels: DataFrame, store, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Statistics and verdict per document row: doc_id, the statistics, base_failed, kept.

    Null and empty texts have no words and fail the base rules. Rows of a repeated doc_id are each judged by their own text; a null
    doc_id is judged like any other. Only doc_id and text are read, whatever else ``docs`` has. ``store`` keeps the measured table,
    which calibration and verdict both read.
    """
    measured = store(with_statistics(docs.select(F.col("doc_id").cast("bigint"), "text")).select("doc_id", "q"), "rules")
    return verdict(measured, calibrate(measured, labels, risk, level)).select("doc_id", "q.*", "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, store, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """The rows of ``docs`` that pass, all their columns unchanged. The rows are stored once with their statistics, which calibration and verdict read."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    measured = store(with_statistics(docs.select(row, F.col("doc_id").cast("bigint"), "text")).drop("text"), "rules")
    return verdict(measured, calibrate(measured.select("doc_id", "q"), labels, risk, level)).where("kept").select("row.*")
