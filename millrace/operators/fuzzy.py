"""Best fuzzy match between two columns of names.

The score is the indel ratio as a whole number: 100 · 2·LCS / (la + lb), rounded
half to even. A score above ``min_score`` bounds the indel distance of a pair by
D = floor((la + lb) · (199 − 2·min_score) / 200), which gives a lossless blocking:

* cut the right name into D + 2 pieces; D edits touch at most D of them, so at
  least two pieces sit unchanged in the left name, shifted by at most what D and
  the length difference allow;
* of the D + 2 pieces any D + 1 still contain an unchanged one, so the piece that
  is most common over all names (a shared first word, say) is left out;
* pieces meet their counterparts in an equality join, pairs are dropped inside
  that join by the built-in bounded Levenshtein distance (never above the indel
  distance), and only survivors are scored.

Names are compared once per distinct value; equal names match by plain join; and
stricter score levels run first so that names settled there skip the wide search.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ranking import top_one
from millrace.session import pin

LOWEST_MIN_SCORE = 80
PAIR = T.StructType([T.StructField("score", T.IntegerType()), T.StructField("ratio", T.DoubleType())])


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character of ``b``."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & where.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


@F.pandas_udf(PAIR)
def _pair_score(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    ratios = [indel_ratio(x, y) for x, y in zip(a, b)]
    return pd.DataFrame({"score": [round(100 * r) for r in ratios], "ratio": ratios})


def _partner_sizes(own: str, slack: int) -> Column:
    """Lengths a partner of this name may have."""
    size = F.length(own)
    low = F.ceil(size * (200 - slack) / (200 + slack)).cast("int")
    high = F.floor(size * (200 + slack) / (200 - slack)).cast("int")
    return F.sequence(low, high)


def _index(right: DataFrame, slack: int) -> DataFrame:
    """(size, budget, piece no, piece, name): the rarest budget + 1 pieces of every right name."""
    budget = F.array_distinct(F.transform(
        _partner_sizes("r", slack), lambda other: F.floor((F.length("r") + other) * slack / 200).cast("int")
    ))
    budgets = (
        right.withColumns({"__size": F.length("r"), "__d": F.explode(budget)}).filter(F.col("__d") >= 1)
    )
    pieces = budgets.withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__d") + 1)))
    start = F.floor(F.col("__i") * F.col("__size") / (F.col("__d") + 2)).cast("int")
    stop = F.floor((F.col("__i") + 1) * F.col("__size") / (F.col("__d") + 2)).cast("int")
    pieces = pieces.withColumn("__piece", F.substring(F.col("r"), start + 1, stop - start))
    where = ["__size", "__d", "__i", "__piece"]
    counted = pieces.join(pieces.groupBy(*where).agg(F.count("*").alias("__n")), where)
    # One group per name and budget: budget + 2 rows.
    ranked = counted.groupBy("r", "__size", "__d").agg(
        F.array_sort(F.collect_list(F.struct("__n", "__i", "__piece"))).alias("__all")
    )
    kept = ranked.withColumn("__p", F.explode(F.slice(F.col("__all"), 1, F.col("__d") + 1)))
    return kept.select("r", "__size", "__d", F.col("__p.__i").alias("__i"), F.col("__p.__piece").alias("__piece"))


def _probes(left: DataFrame, slack: int) -> DataFrame:
    """Every text of a left name that may equal a piece of a right name of a possible length."""
    sized = (
        left.withColumn("__size", F.explode(_partner_sizes("l", slack)))
        .withColumn("__d", F.floor((F.col("__size") + F.length("l")) * slack / 200).cast("int"))
        .filter(F.col("__d") >= 1)
        .withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__d") + 1)))
    )
    start = F.floor(F.col("__i") * F.col("__size") / (F.col("__d") + 2)).cast("int")
    stop = F.floor((F.col("__i") + 1) * F.col("__size") / (F.col("__d") + 2)).cast("int")
    placed = sized.withColumns({"__at": start, "__len": stop - start, "__gap": F.length("l") - F.col("__size")})
    # Edits before the piece number at least |shift|, edits after it at least |gap - shift|.
    low = F.ceil((F.col("__gap") - F.col("__d")) / 2).cast("int") + F.col("__at")
    high = F.floor((F.col("__gap") + F.col("__d")) / 2).cast("int") + F.col("__at")
    placed = placed.withColumns({
        "__low": F.greatest(low, F.lit(0)),
        "__high": F.least(high, F.length("l") - F.col("__len")),
    }).filter(F.col("__low") <= F.col("__high"))
    texts = F.array_distinct(F.transform(
        F.sequence(F.col("__low"), F.col("__high")),
        lambda p: F.substring(F.col("l"), p + 1, F.col("__len")),
    ))
    return placed.select("l", "__size", "__d", "__i", F.explode(texts).alias("__piece"))


def near_best(left: DataFrame, right: DataFrame, min_score: int) -> DataFrame:
    """(l, r, score, ratio): best partner above ``min_score`` of each distinct, non-empty left name."""
    slack = 199 - 2 * min_score
    pairs = (
        _probes(left, slack)
        .join(_index(right, slack), ["__size", "__d", "__i", "__piece"])
        .filter(F.expr("levenshtein(l, r, __d) >= 0"))
        .select("l", "r").distinct()  # a pair meets once for each piece it shares; it is scored once
    )
    scored = pairs.withColumn("__s", _pair_score("l", "r")).select("l", "r", "__s.score", "__s.ratio")
    return top_one(
        scored.filter(F.col("score") > min_score), ["l"],
        [F.col("score").desc(), F.col("ratio").desc(), F.col("r").asc()],
    )


def fuzzy_best(left: DataFrame, right: DataFrame, col: str, right_col: str | None = None, min_score: int = 90,
               levels: tuple[int, ...] = (96,), matched: str = "matched", score: str = "score") -> DataFrame:
    """``left`` with its best right name and score; null when no name scores above ``min_score``.

    Ties go to the higher unrounded ratio, then to the smaller name. ``min_score`` under 80 is refused. Building the
    result runs jobs: the distinct names and each settled level are pinned.
    """
    if min_score < LOWEST_MIN_SCORE:
        raise ValueError(f"blocking needs min_score >= {LOWEST_MIN_SCORE}")
    # Distinct names are read many times below; pinned, their source is read once. Filters come
    # after that, or they would be pushed down and repeat whatever expression made the name.
    ls = pin(left.select(F.col(col).alias("l")).distinct()).filter(F.length("l") > 0)
    rs = pin(right.select(F.col(right_col or col).alias("r")).distinct()).filter(F.length("r") > 0)
    same = rs.select(F.col("r").alias("l"), "r")
    found = [ls.join(same, "l").select("l", "r", F.lit(100).alias("score"))]
    open_names = ls.join(same, "l", "left_anti")
    for level in sorted({s for s in levels if s > min_score}, reverse=True):
        # One row per settled name; pinned because it is both kept and subtracted.
        hits = pin(near_best(open_names, rs, level).select("l", "r", "score"))
        found.append(hits)
        open_names = open_names.join(hits, "l", "left_anti")
    found.append(near_best(open_names, rs, min_score).select("l", "r", "score"))
    answer = found[0]
    for more in found[1:]:
        answer = answer.unionByName(more)
    answer = answer.select(F.col("l").alias(col), F.col("r").alias(matched), F.col("score").alias(score))
    return left.join(answer, col, "left")
