"""The given tables reshaped to the inputs of the policy, contact, audience and claim operators.

Each shape exists twice: as a DataFrame function and as the SQL text (``*_SQL``,
a list of CTEs) the SQL counterparts build on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.registry import table

DAY = "MM/dd/yyyy"


def money(name: str):
    return F.col(name).cast("decimal(18,2)")


# ---------------------------------------------------------------- policies

def items(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf, "lineitem")
    tax = F.col("l_tax")
    return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.lit(1).alias("iteration_nbr"),
        F.col("l_orderkey").alias("pol_pk_id"), F.col("l_suppkey").alias("reg_pk_id"), F.col("o_custkey").alias("agmt_gid"),
        F.concat(F.lit("P"), F.col("l_orderkey").cast("string")).alias("policy_nbr"),
        F.col("l_partkey").cast("string").alias("veh_no"), F.col("l_linestatus").alias("risk_state_abbr"),
        F.date_format("o_orderdate", DAY).alias("policy_effective_dt"), F.date_format("l_shipdate", DAY).alias("trans_eff_dt"),
        F.when(F.col("l_returnflag") == "R", "VEHICLE").otherwise("HNO").alias("item_type"),
        F.when(tax == 0.08, "PUB").when(tax != 0.07, "TRUCK").alias("auto_class_type_desc"),
        F.col("l_linenumber").alias("veh_seq_nbr"),
        money("l_extendedprice").alias("liab_prm"), money("l_quantity").alias("coll_prm"),
        (money("l_quantity") * 2).cast("decimal(18,2)").alias("otc_prm"), money("l_discount").alias("med_prm"),
        money("l_tax").alias("nf_prem"), (money("l_quantity") * 3).cast("decimal(18,2)").alias("udm_prm"),
        (money("l_quantity") * 4).cast("decimal(18,2)").alias("um_prm"), money("l_quantity").alias("umpd_prm"),
    )


ITEM_TIES = ["liab_prm", "veh_seq_nbr", "coll_prm", "med_prm", "nf_prem", "reg_pk_id", "item_type"]


def policies(spark: SparkSession, sf: str) -> DataFrame:
    orders, cust = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    pri = F.col("o_orderpriority")
    days = F.when(pri == "1-URGENT", 0).when(pri == "2-HIGH", 182).when(pri == "5-LOW", 400).otherwise(365)
    seg = F.col("c_mktsegment")
    fixed = lambda v: F.lit(v).cast("decimal(18,2)")
    return orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.lit(1).alias("iteration_nbr"), F.col("o_orderkey").alias("pol_pk_id"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), days), DAY).alias("policy_expiration_dt"),
        F.when(pri == "3-MEDIUM", "SMALL").otherwise("MIDDLE MARKET").alias("bus_seg_grp_desc"),
        F.when(seg == "BUILDING", "5").otherwise(F.substring(seg, 1, 1)).alias("writing_company_cd"), seg.alias("writing_company_desc"),
        F.when(F.col("o_orderstatus") == "P", "P").otherwise("F").alias("auto_are_full_supp_cd"),
        F.when(F.col("o_totalprice") < 250000, fixed("0")).otherwise(F.floor(F.col("o_totalprice") / 100).cast("decimal(18,2)")).alias("doc_prm"),
        F.when(F.col("o_orderstatus") == "F", fixed("0")).otherwise(fixed("10")).alias("enol_prm"), fixed("0").alias("ha_prm"),
        F.when(pri != "4-NOT SPECIFIED", fixed("0")).alias("plt_prm"),
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.lit(1).alias("iteration_nbr"), F.col("s_suppkey").alias("reg_pk_id"), F.greatest(money("s_acctbal") - F.lit("8000").cast("decimal(18,2)"), F.lit("0").cast("decimal(18,2)")).alias("pnol_prm")
    )


def policy_dim(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("agmt_gid"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.concat(F.lit("A"), key)).alias("acct_id"),
        F.concat(F.lit("L"), key).alias("pol_id"),
    )


POLICY_SQL = """
items AS (
  SELECT 1 AS iteration_nbr, l_orderkey AS pol_pk_id, l_suppkey AS reg_pk_id, o_custkey AS agmt_gid,
         'P' || CAST(l_orderkey AS VARCHAR) AS policy_nbr, CAST(l_partkey AS VARCHAR) AS veh_no,
         l_linestatus AS risk_state_abbr, strftime(o_orderdate, '%m/%d/%Y') AS policy_effective_dt,
         strftime(l_shipdate, '%m/%d/%Y') AS trans_eff_dt,
         CASE WHEN l_returnflag = 'R' THEN 'VEHICLE' ELSE 'HNO' END AS item_type,
         CASE WHEN l_tax = 0.08::DOUBLE THEN 'PUB' WHEN l_tax <> 0.07::DOUBLE THEN 'TRUCK' END AS auto_class_type_desc,
         l_linenumber AS veh_seq_nbr,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS liab_prm, CAST(l_quantity AS DECIMAL(18,2)) AS coll_prm,
         CAST(l_quantity AS DECIMAL(18,2)) * 2 AS otc_prm, CAST(l_discount AS DECIMAL(18,2)) AS med_prm,
         CAST(l_tax AS DECIMAL(18,2)) AS nf_prem, CAST(l_quantity AS DECIMAL(18,2)) * 3 AS udm_prm,
         CAST(l_quantity AS DECIMAL(18,2)) * 4 AS um_prm, CAST(l_quantity AS DECIMAL(18,2)) AS umpd_prm
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
policies AS (
  SELECT 1 AS iteration_nbr, o_orderkey AS pol_pk_id,
         strftime(CAST(o_orderdate AS DATE) + CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 182
                  WHEN '5-LOW' THEN 400 ELSE 365 END, '%m/%d/%Y') AS policy_expiration_dt,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'SMALL' ELSE 'MIDDLE MARKET' END AS bus_seg_grp_desc,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '5' ELSE substr(c_mktsegment, 1, 1) END AS writing_company_cd,
         c_mktsegment AS writing_company_desc,
         CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE 'F' END AS auto_are_full_supp_cd,
         CASE WHEN o_totalprice < 250000 THEN 0.00 ELSE CAST(floor(o_totalprice / 100) AS DECIMAL(18,2)) END AS doc_prm,
         CASE WHEN o_orderstatus = 'F' THEN 0.00 ELSE 10.00 END AS enol_prm, 0.00 AS ha_prm,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 0.00 END AS plt_prm
  FROM orders JOIN customer ON o_custkey = c_custkey),
regions AS (SELECT 1 AS iteration_nbr, s_suppkey AS reg_pk_id, greatest(CAST(s_acctbal AS DECIMAL(18,2)) - 8000, 0) AS pnol_prm FROM supplier),
policy_dim AS (
  SELECT c_custkey AS agmt_gid, CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'A' || CAST(c_custkey AS VARCHAR) END AS acct_id,
         'L' || CAST(c_custkey AS VARCHAR) AS pol_id FROM customer),
vehicles AS (
  SELECT * FROM (
    SELECT i.*, p.policy_expiration_dt, p.bus_seg_grp_desc, p.writing_company_cd, p.writing_company_desc,
           p.doc_prm, p.enol_prm, p.ha_prm, p.plt_prm, r.pnol_prm,
           CASE WHEN i.item_type = 'VEHICLE' THEN 1 ELSE 0 END AS is_vehicle,
           CASE WHEN p.auto_are_full_supp_cd = 'F' THEN 0 ELSE 1 END AS part_support,
           row_number() OVER (PARTITION BY i.policy_nbr, strptime(i.policy_effective_dt, '%m/%d/%Y'), i.veh_no, i.risk_state_abbr
             ORDER BY strptime(i.trans_eff_dt, '%m/%d/%Y') DESC NULLS FIRST, liab_prm DESC NULLS FIRST, veh_seq_nbr DESC NULLS FIRST,
               coll_prm DESC NULLS FIRST, med_prm DESC NULLS FIRST, nf_prem DESC NULLS FIRST, i.reg_pk_id DESC NULLS FIRST,
               item_type DESC NULLS FIRST) AS rn
    FROM items i JOIN policies p ON i.pol_pk_id = p.pol_pk_id JOIN regions r ON i.reg_pk_id = r.reg_pk_id
    WHERE i.iteration_nbr IN (1) AND p.iteration_nbr IN (1) AND r.iteration_nbr IN (1) AND i.auto_class_type_desc <> 'PUB')
  WHERE rn = 1),
rolled AS (
  SELECT v.agmt_gid, d.acct_id, d.pol_id, policy_nbr, policy_effective_dt, policy_expiration_dt, bus_seg_grp_desc,
         writing_company_cd, writing_company_desc,
         sum(liab_prm * is_vehicle) AS liab_prm, sum(coll_prm * is_vehicle) AS coll_prm, sum(otc_prm * is_vehicle) AS otc_prm,
         sum(med_prm * is_vehicle) AS med_prm, sum(nf_prem * is_vehicle) AS nf_prem, sum(udm_prm * is_vehicle) AS udm_prm,
         sum(um_prm * is_vehicle) AS um_prm, sum(umpd_prm * is_vehicle) AS umpd_prm,
         max(doc_prm) AS doc_prm, max(enol_prm) AS enol_prm, max(ha_prm) AS ha_prm, max(plt_prm) AS plt_prm, max(pnol_prm) AS pnol_prm,
         sum(is_vehicle) AS n_vehicles, sum(part_support) AS n_part_support,
         least(date_diff('day', strptime(policy_effective_dt, '%m/%d/%Y'), strptime(policy_expiration_dt, '%m/%d/%Y')), 365) AS policy_term,
         CAST(quarter(strptime(policy_expiration_dt, '%m/%d/%Y')) AS VARCHAR) || 'Q' ||
           CAST(year(strptime(policy_expiration_dt, '%m/%d/%Y')) AS VARCHAR) AS expiration_quarter
  FROM vehicles v LEFT JOIN policy_dim d ON v.agmt_gid = d.agmt_gid
  WHERE bus_seg_grp_desc = 'MIDDLE MARKET'
  GROUP BY v.agmt_gid, d.acct_id, d.pol_id, policy_nbr, policy_effective_dt, policy_expiration_dt, bus_seg_grp_desc,
           writing_company_cd, writing_company_desc),
numbered AS (
  SELECT * REPLACE (coalesce(acct_id, CAST(row_number() OVER (ORDER BY policy_nbr NULLS LAST,
           strptime(policy_effective_dt, '%m/%d/%Y') NULLS LAST, policy_expiration_dt NULLS LAST, agmt_gid NULLS LAST, pol_id NULLS LAST,
           writing_company_cd NULLS LAST, writing_company_desc NULLS LAST, acct_id NULLS LAST) AS VARCHAR) || 'AUTOGEN') AS acct_id)
  FROM rolled),
rated AS (
  SELECT *, CAST(liab_prm AS DOUBLE) * (365.0::DOUBLE / nullif(policy_term, 0)) AS annual_liab_prm,
         CAST(doc_prm + enol_prm + ha_prm + plt_prm + pnol_prm AS DOUBLE) * (365.0::DOUBLE / nullif(policy_term, 0)) AS total_hno_prm,
         writing_company_cd IN ('H', '5') OR n_vehicles = 0 AS scored
  FROM numbered),
tiers AS (
  SELECT *, CASE WHEN n_vehicles > 0 THEN 0 ELSE 1 END AS hno_only, CASE WHEN n_part_support > 0 THEN 0 ELSE 1 END AS full_support,
    CASE WHEN NOT scored THEN 3 WHEN n_part_support > 0 THEN 2
         WHEN n_vehicles > 0 THEN CASE WHEN annual_liab_prm < 30000 THEN 1 ELSE 2 END
         ELSE CASE WHEN total_hno_prm < 3000 THEN 1 ELSE 2 END END AS touch_rank,
    CASE WHEN NOT scored THEN 'Writing company not scored' WHEN n_part_support > 0 THEN 'Partially supported'
         WHEN n_vehicles > 0 THEN CASE WHEN annual_liab_prm < 30000 THEN 'Less than $30K liability premium'
           ELSE 'Greater than $30K liability premium' END
         ELSE CASE WHEN total_hno_prm < 3000 THEN 'HNO only, less than $3K total premium'
           ELSE 'HNO only, greater than $3K total premium' END END AS touch_reason
  FROM rated),
worst AS (
  SELECT t.*, CASE m.r WHEN 1 THEN 'LOW' WHEN 2 THEN 'NOT LOW' ELSE 'NOT APPLICABLE' END AS touch, m.r AS account_rank
  FROM tiers t LEFT JOIN (SELECT acct_id, expiration_quarter, max(touch_rank) AS r FROM tiers GROUP BY 1, 2) m
    ON t.acct_id = m.acct_id AND t.expiration_quarter = m.expiration_quarter)
"""


# ---------------------------------------------------------------- contacts

def _id_parts(user: Column) -> tuple[Column, Column]:
    """The four and six digits of a policy id; an id that needs more digits is an error, not a shorter one."""
    fits = F.when((user >= 0) & (user < 10**10), user).otherwise(F.raise_error(F.concat(F.lit("no ten-digit id: "), user.cast("string"))).cast("bigint"))
    return F.lpad(F.expr("user_id div 1000000").cast("string"), 4, "0"), F.lpad((fits % 1000000).cast("string"), 6, "0")


def contact_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    high, low = _id_parts(F.col("user_id"))
    return e.select(
        "event_id", F.concat(high, F.lit("-"), low, F.lit("/EV")).alias("pol_id"),
        F.col("ts").alias("date_time"),
        F.when(kind == "click", "Web").when(kind == "view", "Phone").when(kind == "signup", "eMail").when(kind == "purchase", "Mail").otherwise("System").alias("channel"),
        F.when(k < 15, "Pay my Bill").when(k < 30, "Renewal").when(k < 45, "Billing Call").when(k < 55, "Audit Notice")
        .when(k < 65, "Get Quote").when(k < 75, "Missing Info").when(k < 85, "Cancellation").when(k < 95, "Unlisted point").alias("touch_point"),
    )


def contact_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Two one-year terms per user, the first starting on some day of 2023."""
    users = table(spark, sf, "events").select("user_id").distinct()
    high, low = _id_parts(F.col("user_id"))
    first = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("user_id") * 7 % 365).cast("int"))
    return users.select(
        F.concat(high, F.lit(" "), low).alias("pol_id"),
        F.explode(F.array(first, F.date_add(first, 365))).alias("term_eff_dt"),
    )


CONTACT_SQL = """
contacts AS (
  SELECT event_id, lpad(CAST(user_id // 1000000 AS VARCHAR), 4, '0') || '-' || lpad(CAST(user_id % 1000000 AS VARCHAR), 6, '0') || '/EV' AS pol_id,
         ts AS date_time,
         CASE event_type WHEN 'click' THEN 'Web' WHEN 'view' THEN 'Phone' WHEN 'signup' THEN 'eMail' WHEN 'purchase' THEN 'Mail' ELSE 'System' END AS channel,
         CASE WHEN k < 15 THEN 'Pay my Bill' WHEN k < 30 THEN 'Renewal' WHEN k < 45 THEN 'Billing Call' WHEN k < 55 THEN 'Audit Notice'
              WHEN k < 65 THEN 'Get Quote' WHEN k < 75 THEN 'Missing Info' WHEN k < 85 THEN 'Cancellation' WHEN k < 95 THEN 'Unlisted point' END AS touch_point
  FROM (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events)),
terms AS (
  SELECT lpad(CAST(user_id // 1000000 AS VARCHAR), 4, '0') || ' ' || lpad(CAST(user_id % 1000000 AS VARCHAR), 6, '0') AS pol_id,
         unnest([DATE '2023-01-01' + CAST(user_id * 7 % 365 AS INTEGER), DATE '2023-01-01' + CAST(user_id * 7 % 365 AS INTEGER) + 365]) AS term_eff_dt
  FROM (SELECT DISTINCT user_id FROM events)),
journey AS (
  SELECT e.event_id, t.pol_id, t.term_eff_dt, e.date_time, CASE WHEN e.channel = 'eMail' THEN 'Email' ELSE e.channel END AS channel, e.touch_point,
         CASE WHEN hour(date_time) >= 6 AND hour(date_time) < 10 THEN 'Morning' WHEN hour(date_time) >= 10 AND hour(date_time) < 17 THEN 'Daytime'
              WHEN hour(date_time) >= 17 AND hour(date_time) < 23 THEN 'Primetime' WHEN hour(date_time) >= 23 OR hour(date_time) < 2 THEN 'Latenight'
              ELSE 'Overnight' END AS day_part,
         CASE WHEN date_diff('day', t.term_eff_dt, CAST(date_time AS DATE)) <= 90 THEN 'Startperiod'
              WHEN date_diff('day', t.term_eff_dt, CAST(date_time AS DATE)) >= 275 THEN 'Endperiod' END AS term_phase,
         strftime(date_time, '%a') AS weekday
  FROM contacts e JOIN terms t
    ON substr(e.pol_id, 1, 4) || ' ' || substr(e.pol_id, 6, 6) = t.pol_id
   AND e.date_time >= t.term_eff_dt AND e.date_time < t.term_eff_dt + 365)
"""


# ---------------------------------------------------------------- audience

def viewing(spark: SparkSession, sf: str) -> DataFrame:
    """Signals with device, channel, whole seconds and the cell (state, class) of the device."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("device"), F.upper("event_type").alias("channel"), "ts", F.floor("value").alias("seconds"), "event_id"
    )
    return e.join(device_cells(spark, sf), "device")


def device_cells(spark: SparkSession, sf: str) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("device"), F.col("n_name").alias("state"), location_class().alias("location_class")
    )


def location_class():
    seg = F.col("c_mktsegment")
    return F.when(seg == "BUILDING", "Metro").when(seg == "MACHINERY", "1L").when(seg == "FURNITURE", "1M").otherwise("rural")


def universe(spark: SparkSession, sf: str) -> DataFrame:
    return device_cells(spark, sf).groupBy("state", "location_class").agg((F.count("*") * 1000).alias("universe"))


AUDIENCE_SQL = """
cells AS (
  SELECT c_custkey AS device, n_name AS state, CASE c_mktsegment WHEN 'BUILDING' THEN 'Metro' WHEN 'MACHINERY' THEN '1L'
         WHEN 'FURNITURE' THEN '1M' ELSE 'rural' END AS location_class
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
viewing AS (
  SELECT user_id AS device, upper(event_type) AS channel, ts, CAST(floor(value) AS BIGINT) AS seconds, event_id, state, location_class
  FROM events JOIN cells ON user_id = device),
universe AS (SELECT state, location_class, count(*) * 1000 AS universe FROM cells GROUP BY 1, 2),
actives AS (SELECT state, location_class, count(DISTINCT device) AS active_pop FROM viewing GROUP BY 1, 2),
people AS (
  SELECT s.state, c.location_class, CAST(sum(universe) AS BIGINT) AS universe, CAST(sum(active_pop) AS BIGINT) AS active_pop
  FROM (SELECT u.*, active_pop FROM universe u LEFT JOIN actives a USING (state, location_class)) p,
       LATERAL (SELECT unnest([p.state, 'India']) AS state) s,
       LATERAL (SELECT unnest(CASE WHEN upper(trim(p.location_class)) <> 'RURAL' THEN [p.location_class, 'U+R', 'U'] ELSE [p.location_class, 'U+R'] END) AS location_class) c
  GROUP BY 1, 2)
"""
