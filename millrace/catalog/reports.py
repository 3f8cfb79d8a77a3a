"""Declination report, feed validation and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.registry import query, table
from millrace.plans import declination, validation
from millrace.session import passing, scratch_path
from millrace.sources import files

FIRST, LAST = "1995-01-01", "2001-12-31"
NUMBERS = [125, 126, 127, 90, 189, 35, 242, 71]


def _padded(key, width: int):
    """Zeros in front up to ``width``; longer keys stay whole."""
    return F.when(F.length(key) < width, F.lpad(key, width, "0")).otherwise(key)


def _sources(spark, sf):
    t = lambda n: table(spark, sf, n)
    o, c, n, s, li, p = (t(x) for x in ("orders", "customer", "nation", "supplier", "lineitem", "part"))
    nation_id = (-(F.col("n_nationkey") + 1)).cast("long")
    orgs = c.select(
        F.col("c_custkey").alias("orgnztn_id"),
        F.when(F.col("c_acctbal") > 9000, F.concat(F.lit("(DNU) "), "c_name")).otherwise(F.col("c_name")).alias("orgnztn_name"),
        F.lit("C").alias("orgnztn_shrt_name"), F.concat(F.col("c_mktsegment"), F.lit("\nwork ")).alias("oprtns_dscrptn"),
    ).unionByName(n.select(
        nation_id.alias("orgnztn_id"), F.col("n_name").alias("orgnztn_name"), F.concat(F.lit("N"), F.col("n_regionkey").cast("string")).alias("orgnztn_shrt_name"),
        F.lit(None).cast("string").alias("oprtns_dscrptn"),
    ))
    st, pri = F.col("o_orderstatus"), F.col("o_orderpriority")
    home = (-(F.col("c_nationkey") + 1)).cast("long")
    requests = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("cnsmr_rqst_id"), F.col("o_custkey").alias("cnsmr_orgnztn_id"), home.alias("sbmttng_prdcr_orgnztn_id"),
        F.when(pri != "5-LOW", home).alias("ro_orgnztn_id"), F.when(st == "P", F.col("o_custkey")).alias("sccssfl_crrr_id"),
        F.col("o_custkey").alias("assgnd_to_prsn_id"), F.col("c_nationkey").cast("long").alias("sbmttng_agnt_prsn_id"),
        F.when(st == "F", "SUCCESSFUL").otherwise("DECLINED").alias("stts_name"), F.substring("c_mktsegment", 1, 4).alias("sgmnt_name"),
        F.to_date("o_orderdate").alias("term_effctv_date"), F.concat(pri, F.lit(", late")).alias("rsn_text"), pri.alias("request_type"), st.alias("producer_code"),
    )
    people = s.select(F.col("s_suppkey").alias("prsn_id"), F.col("s_name").alias("last_name"), F.when(F.col("s_acctbal") > 3000, F.lit("Ann")).alias("frst_name"))
    option = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    options = li.select(F.col("l_orderkey").alias("cnsmr_rqst_id"), option.alias("smmry_optn_id"), F.col("l_orderkey").alias("wrksht_optn_id")).distinct()
    approvals = li.groupBy(F.col("l_orderkey").alias("cnsmr_rqst_id"), option.alias("smmry_optn_id")).agg(
        F.max(F.col("l_returnflag") == "R").alias("sold"), F.max(F.col("l_linestatus") == "F").alias("ok")
    ).select(
        "cnsmr_rqst_id", "smmry_optn_id", F.col("smmry_optn_id").alias("apprvl_id"), F.when(F.col("sold"), "Y").alias("sold_indctr"), F.when(F.col("ok"), "Y").alias("apprvd_indctr")
    )
    info = lambda k: (option * 2 + k).alias("accnt_infrmtn_id")
    infos = li.where("l_linenumber <> 7").select(option.alias("smmry_optn_id"), info(0)).unionByName(
        li.where("l_quantity > 45").select(option.alias("smmry_optn_id"), info(1))
    ).distinct()
    values = li.select(
        info(0), F.explode(F.array(*[F.lit(x) for x in NUMBERS])).alias("elmnt_id"),
        F.floor("l_extendedprice").cast("double").alias("__v"), "l_returnflag", "l_discount",
    ).select(
        "accnt_infrmtn_id", "elmnt_id", F.when(F.col("l_discount") > 0, F.col("__v") + F.col("elmnt_id")).alias("nmbr_vl"),
        F.when(F.col("l_returnflag") == "R", "Admin").alias("char_vl"),
    )
    elements = values.select("elmnt_id", F.col("elmnt_id").alias("elmnt_nmbr")).distinct()
    lp = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    ptype = F.col("p_type")
    product = F.when(ptype == "ECONOMY", "WC").when(ptype == "SMALL", "AL").when(ptype == "PROMO", "PREM").otherwise(ptype)
    ratings = lp.select(
        F.col("l_orderkey").alias("cnsmr_rqst_id"), option.alias("smmry_optn_id"), product.alias("prdct_shrt_name"),
        F.to_date("l_shipdate").alias("plan_effctv_date"), F.concat(F.lit("Carrier "), F.col("l_suppkey").cast("string")).alias("carrier_name"),
    )
    layers = lp.select(F.col("l_orderkey").alias("wrksht_optn_id"), product.alias("prdct_shrt_name"))
    key = F.col("c_custkey").cast("string")
    addresses = c.select(
        F.col("c_custkey").alias("orgnztn_id"), F.col("c_custkey").alias("addrss_id"), F.concat(key, F.lit(" Main St ")).alias("address_1"), F.lit(None).cast("string").alias("address_2"),
        F.when(F.col("c_acctbal") > 1000, F.lit("Millford")).alias("city"), F.lit("CT").alias("state"), _padded(key, 5).alias("zip"), F.lit("0001").alias("zip_extn"),
    )
    phone = {"phn_area": F.lit("860"), "phn_exchng": F.lit("555"), "phn_nmbr": _padded(key, 4), "phn_extnsn": F.when(F.col("c_acctbal") > 5000, F.lit("7"))}
    parts = [v.alias(k) for k, v in phone.items()]
    phones = c.select(F.col("c_custkey").alias("orgnztn_id"), F.when(F.col("c_mktsegment") == "BUILDING", "FAX").otherwise("MAIN").alias("phn_usg"), *parts)
    contacts = c.select(
        F.col("c_custkey").alias("orgnztn_id"), F.when(F.col("c_acctbal") > 4000, "CONTACT").otherwise("INVOICE RECIPIENT").alias("role_name"),
        F.lit("Bo").alias("frst_name"), F.col("c_name").alias("last_name"), F.lit("WORK").alias("phn_usg"), *parts,
    )
    contacts = contacts.unionByName(contacts.withColumns({"role_name": F.lit("CONTACT"), "frst_name": F.lit("Cy")}))
    credits = o.select(F.col("o_orderkey").alias("cnsmr_rqst_id"), F.col("o_orderkey").alias("review_id"), F.when(pri == "3-MEDIUM", "OPEN").otherwise("COMPLETE").alias("review_status"), F.substring(pri, 1, 1).alias("credit_rating"))
    snapshots = o.select(
        F.col("o_custkey").alias("orgnztn_id"), F.to_date("o_orderdate").alias("as_of_date"), F.when(st == "F", "CA").otherwise("NY").alias("stt_abbrvtn"),
        F.floor("o_totalprice").cast("double").alias("expsr_amnt"), F.when(pri == "5-LOW", "OTHER").otherwise("PAYROLL").alias("expsr_type"),
    )
    roles = c.select(
        F.col("c_custkey").alias("orgnztn_id"), F.col("c_name").alias("last_name"), F.when(F.col("c_acctbal") > 0, 1).otherwise(2).alias("role_grp_id"),
        F.explode(F.array(F.lit("H/O UNDERWRITER"), F.when(F.col("c_acctbal") > 5000, "LOSS CONTROL CONSULTANT").otherwise("LOSS CONTROL ACCOUNT MANAGER"))).alias("role_name"),
    )
    groups = roles.select("role_grp_id", F.when(F.col("role_grp_id") == 1, "ACCOUNT TEAM").otherwise("OTHER TEAM").alias("grp_name")).distinct()
    return {
        "requests": requests, "orgs": orgs, "people": people, "options": options, "approvals": approvals, "infos": infos, "values": values, "elements": elements, "ratings": ratings,
        "layers": layers, "addresses": addresses, "phones": phones, "contacts": contacts, "credits": credits, "snapshots": snapshots, "roles": roles, "groups": groups,
    }


VALUES = ", ".join(str(x) for x in NUMBERS)
REPORT_SQL = f"""
WITH orgs AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 9000 THEN '(DNU) ' || c_name ELSE c_name END AS name, 'C' AS short, c_mktsegment || ' work' AS ops FROM customer
  UNION ALL SELECT -(n_nationkey + 1)::BIGINT, n_name, 'N' || CAST(n_regionkey AS VARCHAR), NULL FROM nation),
people AS (SELECT s_suppkey AS id, s_name AS last, CASE WHEN s_acctbal > 3000 THEN 'Ann' END AS first FROM supplier),
base AS (SELECT o_orderkey AS rq, o_custkey AS org, a.name AS accnt_name, a.ops AS operations, pr.name AS producer, ro.short AS ro_code, ro.name AS ro_name, ca.name AS successful_carrier,
   x.last || ',' || coalesce(x.first, '') AS produced_by, coalesce(y.first, '') || ' ' || y.last AS producer_contact,
   CASE WHEN o_orderstatus = 'F' THEN 'SUCCESSFUL' ELSE 'DECLINED' END AS status, CAST(o_orderdate AS DATE) AS eff, o_orderpriority || '  late' AS reason, o_orderpriority AS request_type, o_orderstatus AS producer_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN orgs a ON a.id = o_custkey JOIN orgs pr ON pr.id = -(c_nationkey + 1)
  LEFT JOIN orgs ro ON ro.id = CASE WHEN o_orderpriority <> '5-LOW' THEN -(c_nationkey + 1) END LEFT JOIN orgs ca ON ca.id = CASE WHEN o_orderstatus = 'P' THEN o_custkey END
  LEFT JOIN people x ON x.id = o_custkey LEFT JOIN people y ON y.id = c_nationkey
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}' AND a.name NOT LIKE '%(%DNU%)%'),
appr AS (SELECT l_orderkey AS rq, l_orderkey * 10 + l_linenumber AS opt, max(CASE WHEN l_returnflag = 'R' THEN 'Y' END) AS sold, max(CASE WHEN l_linestatus = 'F' THEN 'Y' END) AS ok FROM lineitem GROUP BY 1, 2),
pick AS (SELECT b.rq, max(CASE WHEN (status = 'SUCCESSFUL' AND sold = 'Y') OR (status <> 'SUCCESSFUL' AND ok = 'Y') THEN opt END) AS agreed, max(opt) AS newest FROM base b JOIN appr USING (rq) GROUP BY 1),
chosen AS (SELECT rq, coalesce(agreed, newest) AS opt FROM pick),
lone AS (SELECT opt, max(info) AS info FROM (SELECT l_orderkey * 10 + l_linenumber AS opt, (l_orderkey * 10 + l_linenumber) * 2 AS info FROM lineitem WHERE l_linenumber <> 7
  UNION SELECT l_orderkey * 10 + l_linenumber, (l_orderkey * 10 + l_linenumber) * 2 + 1 FROM lineitem WHERE l_quantity > 45) GROUP BY 1 HAVING count(*) = 1),
vals AS (SELECT (l_orderkey * 10 + l_linenumber) * 2 AS info, no, CASE WHEN l_discount > 0 THEN floor(l_extendedprice) + no END AS v, CASE WHEN l_returnflag = 'R' THEN 'Admin' END AS ch
  FROM lineitem, (SELECT unnest([{VALUES}]) AS no)),
meas AS (SELECT info, sum(CASE WHEN no = 125 THEN v END) AS booked_premium, sum(CASE WHEN no = 126 THEN v END) AS net_written_premium, sum(CASE WHEN no = 127 THEN v END) AS first_dollar_premium,
  sum(CASE WHEN no BETWEEN 87 AND 102 THEN coalesce(v, 0) END) AS loss_pick, sum(CASE WHEN no = 35 THEN coalesce(v, 0) END) AS treaty, sum(CASE WHEN no = 126 THEN coalesce(v, 0) END) AS net,
  sum(CASE WHEN no = 242 THEN coalesce(v, 0) END) AS target, sum(CASE WHEN no IN (71, 75, 79, 83) THEN v END) AS retro,
  CASE WHEN count(*) FILTER (no = 189) = 1 THEN max(CASE WHEN no = 189 THEN coalesce(ch, CAST(CAST(v AS BIGINT) AS VARCHAR)) END) END AS wc_claim_admin FROM vals GROUP BY 1),
lp AS (SELECT l_orderkey AS rq, l_orderkey * 10 + l_linenumber AS opt, CASE p_type WHEN 'ECONOMY' THEN 'WC' WHEN 'SMALL' THEN 'AL' WHEN 'PROMO' THEN 'PREM' ELSE p_type END AS prd, CAST(l_shipdate AS DATE) AS d,
  'Carrier ' || CAST(l_suppkey AS VARCHAR) AS carrier FROM lineitem JOIN part ON l_partkey = p_partkey),
cur AS (SELECT rq, opt, carrier FROM lp QUALIFY row_number() OVER (PARTITION BY rq, opt ORDER BY CASE prd WHEN 'WC' THEN 1 WHEN 'AL' THEN 2 WHEN 'PREM' THEN 3 WHEN 'PROD' THEN 4 ELSE 5 END, d DESC, carrier) = 1),
prods AS (SELECT rq, string_agg(DISTINCT prd, ',' ORDER BY prd) AS products FROM lp GROUP BY 1),
snaps AS (SELECT o_custkey AS org, CAST(o_orderdate AS DATE) AS d, sum(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE 0 END) AS ca, sum(floor(o_totalprice)) AS tot FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2),
expo AS (SELECT b.rq, max(s.d) AS d FROM base b JOIN snaps s ON s.org = b.org AND s.d < b.eff GROUP BY 1)
SELECT b.rq AS cnsmr_rqst_id, accnt_name, strftime(eff, '%m/%d/%Y') AS eff_date, CASE WHEN c_acctbal > 1000 THEN CAST(c_custkey AS VARCHAR) || ' Main St' END AS address_1, NULL::VARCHAR AS address_2,
 CASE WHEN c_acctbal > 1000 THEN 'Millford' END AS city, CASE WHEN c_acctbal > 1000 THEN 'CT' END AS state, CASE WHEN c_acctbal > 1000 THEN lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') END AS zip,
 CASE WHEN c_acctbal > 1000 THEN '0001' END AS zip_extn,
 CASE WHEN c_mktsegment <> 'BUILDING' THEN '860 555 ' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(4, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') || CASE WHEN c_acctbal > 5000 THEN ' x7' ELSE '' END END AS main_phone,
 CASE WHEN c_acctbal > 4000 THEN 'Bo, ' ELSE 'Bo, ' END || c_name AS contact_name, '860 555 ' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(4, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') || CASE WHEN c_acctbal > 5000 THEN ' x7' ELSE '' END AS contact_phone,
 operations, producer, producer_code, producer_contact, produced_by, status, reason, successful_carrier, cur.carrier AS current_carrier,
 CASE WHEN request_type <> '3-MEDIUM' THEN left(request_type, 1) END AS credit_rating, products, loss_pick, wc_claim_admin, NULL::VARCHAR AS gl_claim_admin, NULL::VARCHAR AS al_claim_admin,
 first_dollar_premium, booked_premium, net_written_premium, nullif(tot, 0) AS total_exposure, nullif(ca, 0) AS ca_exposure, round(coalesce(ca, 0) * 100 / nullif(tot, 0), 2) AS ca_exposure_pct, ro_code, ro_name, request_type,
 CASE WHEN c_acctbal > 0 THEN c_name END AS ho_underwriter, CASE WHEN c_acctbal > 5000 THEN c_name END AS lc_consultant, CASE WHEN c_acctbal > 0 AND c_acctbal <= 5000 THEN c_name END AS lc_account_manager,
 NULL::VARCHAR AS lc_account_executive, NULL::DOUBLE AS actual_lc, NULL::DOUBLE AS required_lc, NULL::DOUBLE AS net_at_income, NULL::DOUBLE AS combined_roe,
 round((treaty + net - retro) * 100 / nullif(target - retro, 0), 1) AS sold_to_guide_pct
FROM base b JOIN customer ON c_custkey = b.org LEFT JOIN chosen ch ON ch.rq = b.rq LEFT JOIN lone ON lone.opt = ch.opt LEFT JOIN meas m ON m.info = lone.info LEFT JOIN cur ON cur.rq = b.rq AND cur.opt = ch.opt
LEFT JOIN prods ON prods.rq = ch.rq LEFT JOIN expo e ON e.rq = b.rq LEFT JOIN snaps s ON s.org = b.org AND s.d = e.d"""


@query(REPORT_SQL)
def declination_report(spark, sf):
    return declination.declination_report(_sources(spark, sf), FIRST, LAST, "PAYROLL")


@query("SELECT " + ", ".join(f'{c} AS "{title}"' for c, title in declination.REPORT) + f" FROM ({REPORT_SQL})")
def declination_file(spark, sf):
    """The report as a tab-separated file with all its titles, read back with its types."""
    path = scratch_path(spark, "declined")
    with passing(spark):
        report = declination_report(spark, sf)
        files.write_report(report, declination.REPORT, path)
    titled = T.StructType([T.StructField(title, report.schema[c].dataType) for c, title in declination.REPORT])
    return files.read_csv(spark, path, titled, sep="\t")


@query("""
WITH e AS (SELECT CAST(week(ts) AS INTEGER) AS wk, user_id, event_type, CAST(floor(value) AS BIGINT) AS amount, CASE WHEN value > 50 THEN event_type END AS kind, upper(event_type) AS name FROM events),
n AS (SELECT name FROM e GROUP BY 1), m AS (SELECT name FROM e WHERE amount <= 300 AND name <> 'VIEW' UNION SELECT 'RADIO'),
s AS (SELECT wk, CAST(sum(amount) AS DOUBLE) AS total FROM e WHERE amount <= 320 GROUP BY 1), d AS (SELECT wk, CAST(sum(amount) AS DOUBLE) AS detail FROM e GROUP BY 1)
SELECT 'rows per week' AS check_name, CAST(wk AS VARCHAR) AS check_key, CAST(count(*) AS DOUBLE) AS check_value, 1 AS passed FROM e GROUP BY wk
UNION ALL SELECT 'nulls', 'user_id', CAST(count(*) FILTER (user_id IS NULL) AS DOUBLE), CASE WHEN count(*) FILTER (user_id IS NULL) = 0 THEN 1 ELSE 0 END FROM e
UNION ALL SELECT 'nulls', 'kind', CAST(count(*) FILTER (kind IS NULL) AS DOUBLE), CASE WHEN count(*) FILTER (kind IS NULL) = 0 THEN 1 ELSE 0 END FROM e
UNION ALL SELECT 'unknown names', 'not in master: ' || name, 1, 0 FROM (SELECT name FROM n EXCEPT SELECT name FROM m)
UNION ALL SELECT 'unknown names', 'not in feed: ' || name, 1, 0 FROM (SELECT name FROM m EXCEPT SELECT name FROM n)
UNION ALL SELECT 'duplicate keys', 'all', CAST(count(*) AS DOUBLE), CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM (SELECT 1 FROM e GROUP BY user_id, event_type, wk HAVING count(*) > 1)
UNION ALL SELECT 'summary against detail', CAST(wk AS VARCHAR), round(coalesce(detail, 0) - coalesce(total, 0), 2), CASE WHEN abs(round(coalesce(detail, 0) - coalesce(total, 0), 2)) <= 0.01 THEN 1 ELSE 0 END
 FROM d FULL JOIN s USING (wk)""")
def dq_report(spark, sf):
    e = table(spark, sf, "events").select(
        F.weekofyear("ts").alias("wk"), "user_id", "event_type", F.floor("value").alias("amount"), F.when(F.col("value") > 50, F.col("event_type")).alias("kind"),
        F.upper("event_type").alias("name"),
    )
    radio = table(spark, sf, "events").agg(F.lit("RADIO").alias("name"))
    master = e.filter((F.col("amount") <= 300) & (F.col("name") != "VIEW")).select("name").unionByName(radio)
    summary = e.filter(F.col("amount") <= 320).groupBy("wk").agg(F.sum("amount").alias("total"))
    return validation.feed_checks(e, "wk", ["user_id", "kind"], ["user_id", "event_type", "wk"], (e.select("name"), master), summary, "amount")


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k0, o_orderpriority AS k1 FROM orders WHERE o_custkey IS NOT NULL), b AS (SELECT DISTINCT o_custkey AS k0, o_orderpriority AS k1 FROM orders WHERE o_orderstatus = 'F'
 UNION SELECT s_suppkey, '1-URGENT' FROM supplier)
SELECT 'distinct keys in first' AS measure, count(*) AS n FROM a UNION ALL SELECT 'distinct keys in second', count(*) FROM b
UNION ALL SELECT 'missing from second', count(*) FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'missing from first', count(*) FROM (FROM b EXCEPT FROM a)""")
def reconcile_keys(spark, sf):
    o, s = table(spark, sf, "orders"), table(spark, sf, "supplier")
    b = o.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderpriority").unionByName(
        s.select(F.col("s_suppkey").alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"))
    )
    keys = ["o_custkey", "o_orderpriority"]
    return validation.reconcile_keys(o, b, (keys, keys))
