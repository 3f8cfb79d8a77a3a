"""Interaction of corpus filters: every order of five filters, audited through a recursive CTE over prefixes.

Each document fails some of the filters; the failures are bits of a mask. Documents are counted once into cells, one per part and mask, and
all 120 orders are worked out from those cells. The recursive CTE starts from the empty prefix, extends prefixes by each letter not yet used,
joins the masks at every level and carries the bits applied so far, so that each level emits what its step does to every mask. It has at most
32 masks times 326 prefixes, however many documents or parts there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.tables import store

LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
DUPLICATE_BIT = 16
WALK = """
WITH RECURSIVE filters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
walk(prefix, step, applied, bit, mask) AS (
    SELECT '', 0, 0, 0, mask FROM {masks}
    UNION ALL
    SELECT concat(w.prefix, f.letter), w.step + 1, w.applied | w.bit, f.bit, m.mask
    FROM walk w JOIN filters f ON ((w.applied | w.bit) & f.bit) = 0 JOIN {masks} m ON m.mask = w.mask
    WHERE w.step < 5
)
SELECT prefix, step, mask,
       (mask & (applied | bit)) = 0 AS is_kept,
       (mask & bit) <> 0 AND (mask & applied) = 0 AS is_removed,
       (mask & bit) <> 0 AND (mask & applied) <> 0 AS is_redundant,
       mask = bit AS is_unique
FROM walk WHERE step > 0
"""


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at one text: A few words, B few distinct words, C many capitals, D symbols."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    fails = [
        n < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < n * DISTINCT_PERCENT,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * CAPITAL_PERCENT,
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per part and failure mask: n, n_good, n_toxic.

    Equal texts fail A to D alike, so a text that a third of all rows share is folded into a few rows before the rows of one text meet, and E
    (a smaller doc_id has the same text) follows from the count at the smallest doc_id. Texts are told apart by SHA-256.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text_failures(text).alias("mask"),
    )
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    kind = ["digest", "part", "mask", "good", "toxic"]
    rows = rows.join(known, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    once = rows.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    folded = once.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    folded = folded.withColumn("fresh", F.col("nameless") + F.when(F.col("least") == first, F.col("at_least")).otherwise(0))
    split = F.array(F.struct(F.col("mask"), F.col("fresh").alias("n")), F.struct((F.col("mask") + DUPLICATE_BIT).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))
    both = folded.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"), F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Parts are the values of ``lang``; a null counts as the empty string, a null text as the empty text. A row without doc_id is no
    duplicate and makes none. Repeated rows count each; rows that share the smallest doc_id of a text are not duplicates of each other. A doc_id with
    several labels is good or toxic if any says so; labels without doc_id and other columns are ignored. An empty table has no parts, hence no rows.
    """
    counted = store(cells(docs, labels), "filter-cells")
    steps = docs.sparkSession.sql(WALK, masks=counted.select("mask").distinct())
    of = lambda flag, count="n": F.sum(F.when(F.col(flag), F.col(count)).otherwise(0))
    levels = store(
        counted.join(steps, "mask").groupBy("part", "prefix", "step").agg(
            of("is_kept").alias("kept"), of("is_removed").alias("removed"), of("is_redundant").alias("redundant"), of("is_unique").alias("unique_fails"),
            of("is_removed", "n_good").alias("good_lost"), of("is_removed", "n_toxic").alias("toxic_lost"),
        ), "filter-levels",
    )
    orders = levels.where("step = 5").select("part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step"))
    orders = orders.withColumn("prefix", F.expr("left(filter_order, step)"))
    shapley = F.sum("removed").over(Window.partitionBy("part", F.expr("right(prefix, 1)")))
    return orders.join(levels, ["part", "prefix", "step"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley")
    )


INTERACTIONS_SQL = r"""
WITH plain AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM plain),
marked AS (
    SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, doc_id > least AS e
    FROM worded LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
),
fails AS (
    SELECT part, good, toxic, list_filter([CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END, CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END], lambda x: x IS NOT NULL) AS failed
    FROM marked
),
counted AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, failed),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
outcome AS (
    SELECT c.*, filter_order, step, filter_order[step] AS own, list_contains(failed, filter_order[step]) AS hit,
           len(list_filter(failed, lambda x: contains(left(filter_order, step - 1), x))) AS before, len(failed) AS all_fails
    FROM counted c, orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step) k
),
summed AS (
    SELECT part, filter_order, step, own, sum(CASE WHEN before = 0 AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN before = 0 AND hit THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN before > 0 AND hit THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN hit AND all_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN before = 0 AND hit THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN before = 0 AND hit THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM outcome GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM summed
"""
