"""Join queries: time ranges, lookups, merges, memberships."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs as src
from millrace.catalog.registry import query, table
from millrace.operators import joins, ranges
from millrace.operators.aggregates import share_columns
from millrace.operators.fuzzy import fuzzy_best as fuzzy
from millrace.operators.sessions import sessionize as to_sessions


def _day(name):
    return F.to_date(name)


@query("""
SELECT r_name, n_name, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN supplier ON l_suppkey = s_suppkey
JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2""")
def join_chain(spark, sf):
    t = lambda n: table(spark, sf, n)
    wide = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return wide.groupBy("r_name", "n_name").agg(
        F.count("*").alias("n_lines"), F.sum(src.money("l_extendedprice")).cast("double").alias("revenue")
    )


@query("""
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def left_join(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")


@query("SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1")
def degraded_left_join(spark, sf):
    """A filter on the right side makes a left join an inner one."""
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return d.join(table(spark, sf, "labels").filter(F.col("quality") == 1).select("doc_id", "quality"), "doc_id")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey""")
def role_joins(spark, sf):
    """One dimension joined in two roles."""
    n = table(spark, sf, "nation")
    cn = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"))
    sn = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    return (
        table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer").join(cn, "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "supplier").join(sn, "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "customer_nation", "supplier_nation")
    )


@query(f"WITH {src.CONTACT_SQL} SELECT event_id, pol_id, term_eff_dt, date_time FROM journey")
def interval_join(spark, sf):
    from millrace.plans.journey import with_term_end
    from millrace.functions.text import reformat_id

    events = reformat_id(src.contact_events(spark, sf).select("event_id", "pol_id", "date_time"), "pol_id")
    out = ranges.interval_join(events, with_term_end(src.contact_terms(spark, sf)), "pol_id", "date_time", "term_eff_dt", "term_end_dt")
    return out.select("event_id", "pol_id", "term_eff_dt", "date_time")


@query("""
WITH b AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS t,
  CASE WHEN CAST(o_orderdate AS DATE) = last_day(CAST(o_orderdate AS DATE)) THEN last_day(CAST(o_orderdate - INTERVAL 12 MONTH AS DATE))
       ELSE CAST(o_orderdate - INTERVAL 12 MONTH AS DATE) END AS low FROM orders),
a AS (SELECT l_partkey, l_linenumber, l_suppkey, o_custkey, CAST(l_shipdate AS DATE) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT a.o_custkey, b.o_orderkey, count(*) AS n_valued, min(v) AS first_valued, max(v) AS last_valued
FROM a JOIN b ON a.o_custkey = b.o_custkey AND v < t AND v > low AND v >= DATE '1996-01-01' GROUP BY 1, 2""")
def lookback_join(spark, sf):
    """Shipments of a customer valued in the twelve months before each of its orders."""
    o = table(spark, sf, "orders")
    b = o.select("o_custkey", "o_orderkey", _day("o_orderdate").alias("t"))
    a = table(spark, sf, "lineitem").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", _day("l_shipdate").alias("v")
    )
    hits = ranges.lookback_join(a, b, "o_custkey", "v", "t", 12, floor="1996-01-01")
    return hits.groupBy("o_custkey", "o_orderkey").agg(
        F.count("*").alias("n_valued"), F.min("v").alias("first_valued"), F.max("v").alias("last_valued")
    )


@query("""
WITH snaps AS (SELECT o_custkey AS org, CAST(o_orderdate AS DATE) AS as_of, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(18,2)) AS amt FROM orders),
asks AS (SELECT o_orderkey, o_custkey AS org, CAST(o_orderdate AS DATE) AS eff FROM orders),
hit AS (SELECT k.*, (SELECT max(as_of) FROM snaps s WHERE s.org = k.org AND s.as_of < k.eff) AS asof_as_of FROM asks k),
sums AS (SELECT org, as_of, sum(CASE WHEN st = 'F' THEN amt ELSE 0 END) AS part, sum(amt) AS total FROM snaps GROUP BY 1, 2)
SELECT h.o_orderkey, h.org, h.eff, h.asof_as_of, CAST(nullif(part, 0) AS DOUBLE) AS part, CAST(nullif(total, 0) AS DOUBLE) AS total,
       round(coalesce(CAST(part AS DOUBLE), 0) * 100 / nullif(CAST(total AS DOUBLE), 0), 2) AS pct
FROM hit h LEFT JOIN sums s ON h.org = s.org AND h.asof_as_of = s.as_of""")
def asof_exposure(spark, sf):
    """Amounts at the customer's newest order date strictly before each order."""
    o = table(spark, sf, "orders")
    snaps = o.select(F.col("o_custkey").alias("org"), _day("o_orderdate").alias("as_of"), F.col("o_orderstatus").alias("st"), src.money("o_totalprice").alias("amt"))
    asks = o.select("o_orderkey", F.col("o_custkey").alias("org"), _day("o_orderdate").alias("eff"))
    sums = [F.sum(F.when(F.col("st") == "F", F.col("amt")).otherwise(0)).alias("part"), F.sum("amt").alias("total")]
    out = share_columns(ranges.asof_latest(asks, snaps, "org", "eff", "as_of", sums), ("part", "total", "pct"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("part", "total")})


@query("""
WITH s AS (SELECT user_id, ts AS a0, ts + INTERVAL 1 SECOND * CAST(floor(value * 60) AS BIGINT) AS a1, event_id FROM events),
d AS (SELECT user_id, min(date_trunc('day', ts)) AS b0, max(date_trunc('day', ts)) AS last FROM events GROUP BY 1),
p AS (SELECT user_id, unnest(generate_series(b0 + INTERVAL 18 HOUR, last + INTERVAL 18 HOUR, INTERVAL 1 DAY)) AS b0 FROM d)
SELECT event_id, s.user_id, greatest(a0, b0) AS overlap_start, least(a1, b0 + INTERVAL 5 HOUR) AS overlap_end
FROM s JOIN p ON s.user_id = p.user_id AND a0 < b0 + INTERVAL 5 HOUR AND a1 > b0""")
def overlap_join(spark, sf):
    """Viewing stretches cut to the evening of each day a user is seen around."""
    e = table(spark, sf, "events")
    end = F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value") * 60).cast("decimal(18,6)"))
    shown = e.select("event_id", "user_id", F.col("ts").alias("a0"), end.alias("a1"))
    days = e.groupBy("user_id").agg(F.min(_day("ts")).alias("first"), F.max(_day("ts")).alias("last"))
    evening = days.withColumn("day", F.explode(F.sequence("first", "last"))).select(
        "user_id", (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(18))).alias("b0"),
        (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(23))).alias("b1"),
    )
    return ranges.overlap_join(shown, evening, "user_id", ("a0", "a1"), ("b0", "b1"), instants=True).select("event_id", "user_id", "overlap_start", "overlap_end")


@query("""
SELECT c_custkey, o_orderkey AS option_id, CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS tier FROM customer LEFT JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey DESC) = 1)
ON c_custkey = o_custkey""")
def fallback_lookup(spark, sf):
    """Newest finished order of a customer, else newest open one, else newest of any."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("option_id"), "o_orderstatus")
    tiers = [o.filter(F.col("o_orderstatus") == "F"), o.filter(F.col("o_orderstatus") == "O"), o]
    out = joins.fallback_lookup(table(spark, sf, "customer").select("c_custkey"), tiers, "c_custkey", "option_id")
    return out.select("c_custkey", "option_id", F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("tier"))


@query("""
WITH a AS (SELECT o_orderkey AS claim, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day, o_totalprice AS amount, o_orderpriority AS note FROM orders),
b AS (SELECT l_orderkey AS claim, CASE WHEN min(l_linestatus) = 'F' THEN CAST(o_orderdate AS DATE) END AS day, max(l_extendedprice) AS amount, min(l_returnflag) AS flag
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_orderdate)
SELECT coalesce(a.claim, b.claim) AS claim, coalesce(a.day, b.day) AS day, coalesce(a.amount, b.amount) AS amount, note, flag
FROM a FULL JOIN b ON a.claim IS NOT DISTINCT FROM b.claim AND a.day IS NOT DISTINCT FROM b.day""")
def merge_outer(spark, sf):
    """Two claim lists merged on claim and day, where a missing day matches a missing day."""
    o = table(spark, sf, "orders")
    a = o.select(
        F.col("o_orderkey").alias("claim"), F.when(F.col("o_orderstatus") != "P", _day("o_orderdate")).alias("day"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("note"),
    )
    b = (
        table(spark, sf, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_orderkey").alias("claim"), "o_orderdate")
        .agg(F.min("l_linestatus").alias("s"), F.max("l_extendedprice").alias("amount"), F.min("l_returnflag").alias("flag"))
        .select("claim", F.when(F.col("s") == "F", _day("o_orderdate")).alias("day"), "amount", "flag")
    )
    both = joins.merge_outer(a, b, ["claim", "day"])
    return joins.coalesce_pairs(both, {"amount": ["amount_x", "amount_y"]})


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def missing_keys(spark, sf):
    held = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return joins.missing_keys(table(spark, sf, "customer"), held, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey)")
def semi_team(spark, sf):
    seen = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"))
    return joins.existing_keys(table(spark, sf, "supplier"), seen, ["s_suppkey"]).select("s_suppkey", "s_name")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority FROM lineitem JOIN orders
ON CAST(l_orderkey AS VARCHAR) || l_returnflag = CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE 'A' END""")
def join_on_text(spark, sf):
    a = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    b = table(spark, sf, "orders").withColumn("flag", F.when(F.col("o_orderstatus") == "F", "R").otherwise("A"))
    out = joins.join_on_text(a, b, ["l_orderkey", "l_returnflag"], ["o_orderkey", "flag"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority")


@query("""
SELECT l_orderkey, l_linenumber, o_custkey, o_orderkey FROM lineitem JOIN orders
ON CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) = CAST(o_custkey AS VARCHAR) || CAST(o_orderkey % 100 AS VARCHAR)""")
def join_on_joined_text(spark, sf):
    """The concatenation as the key: ('12', '3') meets ('1', '23')."""
    a = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    b = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 100).alias("tail"))
    out = joins.join_on_text(a, b, ["l_orderkey", "l_linenumber"], ["o_custkey", "tail"], by_parts=False)
    return out.select("l_orderkey", "l_linenumber", "o_custkey", "o_orderkey")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN l_partkey ELSE l_suppkey END AS claim_key FROM lineitem""")
def choose_key(spark, sf):
    master = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.choose_key(li, master, "o_orderkey", "l_partkey", "l_suppkey", "claim_key").drop("l_suppkey")


@query("""
WITH f AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS acct, quarter(o_orderdate) AS q, CAST(left(o_orderpriority, 1) AS INTEGER) AS pri FROM orders)
SELECT f.o_orderkey, f.acct, f.q, f.pri, m.worst FROM f LEFT JOIN (SELECT acct, q, max(pri) AS worst FROM f GROUP BY 1, 2) m ON f.acct = m.acct AND f.q = m.q""".replace("quarter(o_orderdate)", "CAST(quarter(o_orderdate) AS INTEGER)"))
def spread_max(spark, sf):
    f = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("acct"), F.quarter("o_orderdate").alias("q"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("pri"),
    )
    return joins.spread_max(f, ["acct", "q"], "pri", "worst")


@query("""
SELECT c_custkey, o_orderkey AS first_order, o_totalprice AS first_total FROM customer LEFT JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1) ON c_custkey = o_custkey""")
def first_lookup(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", F.col("o_orderkey").alias("first_order"), F.col("o_totalprice").alias("first_total"))
    out = joins.first_lookup(table(spark, sf, "customer").select("c_custkey"), o, "c_custkey", [F.col("o_orderdate").asc(), F.col("first_order").asc()])
    return out.drop("o_orderdate")


@query(f"""WITH {src.CONTACT_SQL} SELECT event_id, touch_point, CASE touch_point WHEN 'Pay my Bill' THEN 'pay' WHEN 'Renewal' THEN 'renewal'
WHEN 'Billing Call' THEN 'bill' WHEN 'Audit Notice' THEN 'audit' WHEN 'Get Quote' THEN 'quote' WHEN 'Missing Info' THEN 'unknown'
WHEN 'Cancellation' THEN 'cancel' END AS touch_point_status FROM contacts""")
def map_values(spark, sf):
    from millrace.plans.journey import touch_map

    return joins.map_values(src.contact_events(spark, sf).select("event_id", "touch_point"), "touch_point", touch_map(spark))


FUZZY_SQL = """
WITH l AS (SELECT DISTINCT p_name || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR) AS name FROM part),
r AS (SELECT DISTINCT p_name || ' ' || p_type AS name FROM part),
p AS (SELECT l.name AS name, r.name AS r, length(l.name) + length(r.name) AS s, {distance} AS d
      FROM l JOIN r ON length(r.name) BETWEEN length(l.name) - 5 AND length(l.name) + 5),
b AS (SELECT * FROM p WHERE {score} > 90 QUALIFY row_number() OVER (PARTITION BY name ORDER BY {score} DESC, d * 1.0 / s, r) = 1)
SELECT l.name, b.r AS matched, CAST({score} AS INTEGER) AS score FROM l LEFT JOIN b ON l.name = b.name"""

# Length of the longest common subsequence as a fold over the characters of the right name.
LCS = """length(l.name) - bit_count(list_reduce(list_transform(string_split(r.name, ''), lambda ch:
  list_sum(list_transform(range(1, length(l.name) + 1), lambda i: CASE WHEN l.name[i] = ch THEN 1::BIGINT << CAST(i - 1 AS INTEGER) ELSE 0::BIGINT END))::BIGINT),
  lambda v, m: ((v + (v & m)) | (v - (v & m))) & ((1::BIGINT << CAST(length(l.name) AS INTEGER)) - 1), (1::BIGINT << CAST(length(l.name) AS INTEGER)) - 1))"""


@query(FUZZY_SQL.format(distance=f"length(l.name) + length(r.name) - 2 * ({LCS})", score="round_even(100.0::DOUBLE * (s - d) / s, 0)"))
def fuzzy_best(spark, sf):
    """Part names with a trailing size against part names: best partner scoring above 90."""
    part = table(spark, sf, "part")
    left = part.select(F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string")).alias("name")).distinct()
    right = part.select(F.concat_ws(" ", "p_name", "p_type").alias("name"))
    return fuzzy(left, right, "name")


@query("""
WITH e AS (SELECT user_id, event_type, CAST(epoch_us(ts) AS BIGINT) AS t, CAST(epoch_us(ts) AS BIGINT) + CAST(floor(value) AS BIGINT) * 1000000 AS e1,
             CAST(floor(value) AS BIGINT) AS w FROM events),
d AS (SELECT user_id, event_type, t, max(e1) AS e1, count(*) AS n, sum(w) AS w FROM e GROUP BY 1, 2, 3),
m AS (SELECT *, max(e1) OVER (PARTITION BY user_id, event_type ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM d),
f AS (SELECT *, sum(CASE WHEN p IS NULL OR t > p + 7200 * 1000000::BIGINT THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT user_id, event_type, make_timestamp(min(t)) AS start_time, make_timestamp(max(e1)) AS end_time, CAST(sum(n) AS BIGINT) AS signals,
       CAST(sum(w) AS BIGINT) AS watch_seconds, CAST((max(e1) - min(t)) // 1000000 AS BIGINT) AS duration
FROM f GROUP BY user_id, event_type, g""")
def sessionize(spark, sf):
    e = table(spark, sf, "events").withColumn("value", F.floor("value"))
    return to_sessions(e, ["user_id", "event_type"], "ts", "value", gap=7200)


@query("""
WITH e AS (SELECT user_id, CAST(epoch_us(ts) AS BIGINT) AS t, CAST(epoch_us(ts) AS BIGINT) + CAST(floor(value) AS BIGINT) * 1000000 AS e1, CAST(floor(value) AS BIGINT) AS w FROM events),
m AS (SELECT *, max(e1) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM e),
f AS (SELECT *, sum(CASE WHEN p IS NULL OR t > p + 7200 * 1000000::BIGINT THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT user_id, make_timestamp(min(t)) AS start_time, count(*) AS signals, CAST((max(e1) - min(t)) // 1000000 AS BIGINT) AS duration
FROM f GROUP BY user_id, g HAVING (max(e1) - min(t)) // 1000000 > 600""")
def long_sessions(spark, sf):
    """Sessions longer than ten minutes."""
    from millrace.operators.filters import min_duration

    e = table(spark, sf, "events").withColumn("value", F.floor("value"))
    return min_duration(to_sessions(e, ["user_id"], "ts", "value", gap=7200), "duration", 600).select("user_id", "start_time", "signals", "duration")
