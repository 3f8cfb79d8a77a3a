"""Aggregation, roll-up, ranking and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs as src
from millrace.catalog.registry import query, table
from millrace.operators import aggregates as agg
from millrace.operators import ranking, setops


@query("SELECT event_type, count(*) AS n, count(CASE WHEN value > 100 THEN value END) AS n_large FROM events GROUP BY 1")
def group_counts(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("value") > 100, F.col("value"))).alias("n_large")
    )


@query("""
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS returned,
CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1""")
def masked_sum(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_suppkey", src.money("l_extendedprice").alias("price"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_returned")
    )
    return li.groupBy("l_suppkey").agg(
        agg.masked_sum("price", "is_returned").cast("double").alias("returned"), F.sum("price").cast("double").alias("total")
    )


@query("""
WITH c AS (SELECT user_id, nullif(count(*) FILTER (event_type = 'click'), 0) AS n_click, nullif(count(*) FILTER (event_type = 'purchase'), 0) AS n_purchase,
 nullif(count(*) FILTER (dayname(ts) = 'Monday'), 0) AS n_mon, nullif(count(*) FILTER (dayname(ts) = 'Tuesday'), 0) AS n_tue, count(event_type) AS n_all FROM events GROUP BY 1)
SELECT *, n_mon + n_tue AS n_mon_tue, coalesce(n_mon, 0) + coalesce(n_tue, 0) AS n_mon_tue_filled FROM c""")
def pivot_counts(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.date_format("ts", "E"))
    specs = {"event_type": {"click": "n_click", "purchase": "n_purchase"}, "day": {"Mon": "n_mon", "Tue": "n_tue"}}
    wide = agg.pivot_counts(e, ["user_id"], specs, ("event_type", "n_all"))
    return wide.withColumns({
        "n_mon_tue": agg.sum_across(["n_mon", "n_tue"]), "n_mon_tue_filled": agg.sum_across(["n_mon", "n_tue"], null_as_zero=True),
    })


@query("SELECT DISTINCT lang, source FROM documents")
def distinct_values(spark, sf):
    return table(spark, sf, "documents").select("lang", "source").distinct()


@query("SELECT count(DISTINCT (l_partkey, l_suppkey)) AS n FROM lineitem")
def count_distinct(spark, sf):
    return agg.count_distinct(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


ELEMENTS = "SELECT DISTINCT l_linenumber AS element, l_linenumber AS number FROM lineitem"


def _attributes(spark, sf):
    li = table(spark, sf, "lineitem")
    vals = li.select(
        F.col("l_orderkey").alias("entity"), F.col("l_linenumber").alias("element"),
        F.when(F.col("l_discount") > 0, src.money("l_extendedprice")).alias("value"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).alias("text"),
    )
    return vals, li.select(F.col("l_linenumber").alias("element"), F.col("l_linenumber").alias("number")).distinct()


@query(f"""
WITH v AS (SELECT l_orderkey AS entity, l_linenumber AS element, CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS value FROM lineitem),
n AS ({ELEMENTS})
SELECT entity, CAST(sum(CASE WHEN number = 1 THEN value END) AS DOUBLE) AS one, CAST(sum(CASE WHEN number BETWEEN 2 AND 4 THEN coalesce(value, 0) END) AS DOUBLE) AS span,
CAST(sum(CASE WHEN number IN (5, 7) THEN value END) AS DOUBLE) AS some FROM v JOIN n USING (element) GROUP BY 1""")
def eav_pivot(spark, sf):
    vals, elems = _attributes(spark, sf)
    out = agg.eav_pivot(vals, elems, "entity", "element", "number", "value", {"one": 1, "span": (2, 4), "some": [5, 7]}, ("span",))
    return out.select("entity", *[F.col(c).cast("double").alias(c) for c in ("one", "span", "some")])


@query(f"""
WITH v AS (SELECT l_orderkey AS entity, l_linenumber AS element, CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS value,
 CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS text FROM lineitem), n AS ({ELEMENTS})
SELECT entity, CASE WHEN count(*) FILTER (number = 1) = 1 THEN max(CASE WHEN number = 1 THEN coalesce(text, CAST(value AS VARCHAR)) END) END AS admin_one,
CASE WHEN count(*) FILTER (number = 2) = 1 THEN max(CASE WHEN number = 2 THEN coalesce(text, CAST(value AS VARCHAR)) END) END AS admin_two
FROM v JOIN n USING (element) GROUP BY 1""")
def eav_scalar(spark, sf):
    vals, elems = _attributes(spark, sf)
    return agg.eav_scalar(vals, elems, "entity", "element", "number", F.col("value").cast("string"), "text", {"admin_one": 1, "admin_two": 2})


@query("""
WITH s AS (SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS part, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1)
SELECT l_suppkey, CAST(nullif(part, 0) AS DOUBLE) AS returned, CAST(nullif(total, 0) AS DOUBLE) AS total,
round(CAST(part AS DOUBLE) * 100 / nullif(CAST(total AS DOUBLE), 0), 2) AS pct FROM s""")
def share_of(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("price", src.money("l_extendedprice"))
    out = agg.share_of(li, ["l_suppkey"], F.col("l_returnflag") == "R", "price", ("returned", "total", "pct"))
    return out.select("l_suppkey", F.col("returned").cast("double").alias("returned"), F.col("total").cast("double").alias("total"), "pct")


@query("SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS products FROM part GROUP BY 1")
def list_products(spark, sf):
    return agg.list_values(table(spark, sf, "part"), "p_brand", "p_type", "products")


@query("""
SELECT o_custkey, min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS urgent, min(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey END) AS high,
min(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey END) AS low FROM orders GROUP BY 1""")
def role_pivot(spark, sf):
    return agg.pivot_first(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_orderkey", {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"})


@query("""
WITH c AS (SELECT n_name AS state, CASE c_mktsegment WHEN 'BUILDING' THEN 'Metro' WHEN 'MACHINERY' THEN '1L' WHEN 'FURNITURE' THEN '1M' ELSE 'rural' END AS cls,
 c_acctbal, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT CASE WHEN n_regionkey < 2 THEN 'South' ELSE 'HSM' END AS grp, cls, count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS bal FROM c GROUP BY 1, 2)
SELECT grp, cls, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bal) AS DOUBLE) AS bal FROM (
  SELECT grp, cls, n, bal FROM s UNION ALL SELECT 'India', cls, n, bal FROM s
  UNION ALL SELECT grp, 'U+R', n, bal FROM s UNION ALL SELECT 'India', 'U+R', n, bal FROM s
  UNION ALL SELECT grp, 'U', n, bal FROM s WHERE cls <> 'rural' UNION ALL SELECT 'India', 'U', n, bal FROM s WHERE cls <> 'rural') GROUP BY 1, 2""")
def rollup_labels(spark, sf):
    from millrace.plans.audience import region_rollups

    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("n_regionkey") < 2, "South").otherwise("HSM").alias("grp"), src.location_class().alias("cls"), F.lit(1).alias("n"), src.money("c_acctbal").alias("bal")
    )
    return region_rollups(c, [], ["n", "bal"], "grp", "cls").withColumn("bal", F.col("bal").cast("double"))


@query("SELECT max(l_shipdate) AS last_ship, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, count(*) FILTER (l_returnflag IS NULL) AS n_null FROM lineitem")
def plain_totals(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.max("l_shipdate").alias("last_ship"), F.sum(src.money("l_quantity")).cast("double").alias("quantity"), F.count_if(F.col("l_returnflag").isNull()).alias("n_null")
    )


@query("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R')")
def exact_duplicates(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.unionByName(li.filter(F.col("l_returnflag") == "R")).dropDuplicates()


@query("SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS signal_count FROM events GROUP BY 1, 2")
def signal_counts(spark, sf):
    return agg.signal_counts(table(spark, sf, "events").withColumn("day", F.to_date("ts")), "day", "user_id")


@query("""
SELECT CAST(ts AS DATE) AS date, user_id, count(*) AS number_of_signals, arg_max(event_type, (ts, event_id)) AS event_type,
arg_max(props, (ts, event_id)) AS props FROM events GROUP BY 1, 2""")
def daily_actives(spark, sf):
    return agg.daily_actives(table(spark, sf, "events"), F.to_date("ts"), ["user_id"], "ts", ["event_id"], ["event_type", "props"])


@query("""
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(floor(value) AS BIGINT) AS x, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS w FROM events)
SELECT event_type, day, CAST(sum(x * w) AS BIGINT) AS rat_length, CAST(sum(x * x) AS BIGINT) AS rat_reach, CAST(sum(x * w) AS DOUBLE) / nullif(CAST(sum(w) AS DOUBLE), 0) AS mean_rat FROM e GROUP BY 1, 2""")
def summary_products(spark, sf):
    """Additive products for weighted means in a summary table."""
    e = table(spark, sf, "events").select(
        "event_type", F.to_date("ts").alias("day"), F.floor("value").alias("x"), F.get_json_object("props", "$.k").cast("long").alias("w")
    )
    return agg.weighted_means(e, ["event_type", "day"], {"rat_length": ("x", "w"), "rat_reach": ("x", "x")}, {"mean_rat": ("x", "w")})


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 3 ELSE 4 END, o_orderdate DESC NULLS FIRST, o_orderkey) = 1""")
def first_by_priority(spark, sf):
    o = table(spark, sf, "orders")
    order = [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").asc()]
    return ranking.first_by(o, "o_custkey", ("o_orderpriority", ["2-HIGH", "1-URGENT", "5-LOW"]), order).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""
SELECT o_custkey, o_orderkey AS review, o_orderpriority AS rating FROM orders WHERE o_orderstatus = 'F'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def latest_complete(spark, sf):
    done = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return ranking.first_by(done, "o_custkey", None, [F.col("o_orderkey").desc()]).select("o_custkey", F.col("o_orderkey").alias("review"), F.col("o_orderpriority").alias("rating"))


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey) = 1""")
def first_by_text(spark, sf):
    order = [F.col("o_orderpriority").desc(), F.col("o_orderkey").asc()]
    return ranking.first_by(table(spark, sf, "orders"), "o_custkey", None, order).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100")
def top_orders(spark, sf):
    """A top-k report."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.first_rows(o, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()], 100)


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return setops.union_by_name(c, s)


@query("SELECT o_custkey AS value FROM orders INTERSECT SELECT l_suppkey FROM lineitem")
def common_values(spark, sf):
    return setops.common_values(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "lineitem"), "l_suppkey")


@query("SELECT o_custkey AS value FROM orders UNION SELECT l_partkey FROM lineitem")
def all_values(spark, sf):
    return setops.all_values(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "lineitem"), "l_partkey")


@query("""
WITH f AS (SELECT DISTINCT p_name || ' ' || p_type AS name FROM part WHERE p_size < 25), m AS (SELECT DISTINCT p_name || ' ' || p_type AS name FROM part WHERE p_size >= 25)
SELECT name, 'not in master' AS reason FROM (SELECT name FROM f EXCEPT SELECT name FROM m)
UNION ALL SELECT name, 'not in feed' FROM (SELECT name FROM m EXCEPT SELECT name FROM f)""")
def set_diff_names(spark, sf):
    p = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name"), "p_size")
    return setops.name_diff(p.filter(F.col("p_size") < 25), p.filter(F.col("p_size") >= 25))
