"""Loss-history linkage, declination report and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.columns import sql_account, sql_match
from millrace.catalog.joins import LCS
from millrace.catalog.registry import query, table
from millrace.plans import linkage
from millrace.session import kept, scratch_path

TODAY = "2002-01-01"


# ---------------------------------------------------------------- linkage

def _sheets(spark, sf):
    """Claim-sheet rows as text, with the subject line and date of the message they came in."""
    o, p = table(spark, sf, "orders"), table(spark, sf, "part")
    li = table(spark, sf, "lineitem")
    rows = li.join(o.join(p, F.col("o_custkey") == F.col("p_partkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    flag, pri = F.col("l_returnflag"), F.col("o_orderpriority")
    name = F.concat(F.regexp_replace("p_name", "ll", "l"), F.lit(" "), "p_type")
    return rows.select(
        F.concat(F.lit("CLM "), F.col("l_orderkey").cast("string")).alias("CLAIM_NUMBER"),
        F.concat(F.lit("Part-"), F.col("l_partkey").cast("string")).alias("CLAIMANT_NAME"),
        F.when(pri != "5-LOW", F.date_format("o_orderdate", "M/d/yyyy")).alias("ACCIDENT_DATE"),
        F.when(flag != "N", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("VALUATION_DATE"),
        F.when(pri != "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("POLICY_EFFECTIVE_DATE"),
        F.concat(F.lit("USD "), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("TOTAL_INCURRED"),
        F.when(flag == "A", F.col("l_linestatus")).alias("CLAIM_STATUS"),
        name.alias("ENTITY"),
        F.when(pri == "2-HIGH", F.lit("RE: Loss Run")).otherwise(F.concat(F.lit("FW: National Account "), name, F.lit(" Inc - Loss Run"))).alias("subject"),
        F.col("l_shipdate").alias("received"), (flag == "R").alias("is_new"),
    )


SHEETS_SQL = f"""
raw AS (
  SELECT 'CLM ' || CAST(l_orderkey AS VARCHAR) AS CLAIM_NUMBER, 'Part-' || CAST(l_partkey AS VARCHAR) AS CLAIMANT_NAME,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS ACCIDENT_DATE,
    coalesce(CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END, CAST(l_shipdate AS DATE)) AS VALUATION_DATE,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS POLICY_EFFECTIVE_DATE, round(l_extendedprice, 2) AS TOTAL_INCURRED,
    CASE WHEN l_returnflag = 'A' THEN l_linestatus END AS CLAIM_STATUS, replace(p_name, 'll', 'l') || ' ' || p_type AS ENTITY,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'RE: Loss Run' ELSE 'FW: National Account ' || replace(p_name, 'll', 'l') || ' ' || p_type || ' Inc - Loss Run' END AS subject,
    l_returnflag = 'R' AS is_new
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON o_custkey = p_partkey),
names AS (SELECT DISTINCT subject, ENTITY FROM raw),
clean AS (SELECT subject, ENTITY, coalesce({sql_account("subject")}, ENTITY) AS sub FROM names),
keyed AS (SELECT subject, ENTITY, sub, {sql_match("sub")} AS k FROM clean),
sheets AS (SELECT DISTINCT CLAIM_NUMBER, CLAIMANT_NAME, ACCIDENT_DATE, VALUATION_DATE, POLICY_EFFECTIVE_DATE, TOTAL_INCURRED, CLAIM_STATUS, raw.ENTITY,
    upper(raw.subject) AS EMAIL_FULL_SUBJECT_LINE, sub, k, is_new FROM raw JOIN keyed ON raw.subject = keyed.subject AND raw.ENTITY = keyed.ENTITY)"""


def _tagged(spark, sf):
    both = kept(linkage.tag_sheets(_sheets(spark, sf), "subject", "received", F.lit(TODAY), ["is_new"]))
    return both.filter("is_new").drop("is_new"), both.filter("NOT is_new").drop("is_new")


@query(f"""WITH {SHEETS_SQL}
SELECT CLAIM_NUMBER, CLAIMANT_NAME, ACCIDENT_DATE, VALUATION_DATE, POLICY_EFFECTIVE_DATE, TOTAL_INCURRED, CLAIM_STATUS, ENTITY, EMAIL_FULL_SUBJECT_LINE,
sub AS ENTITY_FROM_EMAIL_SUBJECT_LINE, k AS ENTITY_FOR_TEXT_MATCHING, is_new FROM sheets""")
def sheet_ingest(spark, sf):
    """Text sheets, new and old, tagged, cleaned, typed and freed of exact duplicates."""
    new, old = _tagged(spark, sf)
    return new.withColumn("is_new", F.lit(True)).unionByName(old.withColumn("is_new", F.lit(False))).select(
        "CLAIM_NUMBER", "CLAIMANT_NAME", "ACCIDENT_DATE", "VALUATION_DATE", "POLICY_EFFECTIVE_DATE", "TOTAL_INCURRED", "CLAIM_STATUS", "ENTITY",
        "EMAIL_FULL_SUBJECT_LINE", "ENTITY_FROM_EMAIL_SUBJECT_LINE", "ENTITY_FOR_TEXT_MATCHING", "is_new",
    )


def _requests(spark, sf):
    o, p = table(spark, sf, "orders"), table(spark, sf, "part")
    return o.join(p, F.col("o_custkey") == F.col("p_partkey")).select(
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(" LLC")).alias("account_name"), F.trunc("o_orderdate", "year").alias("term_effctv_date"),
        F.to_date("o_orderdate").alias("mdfd_date"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("new_renewal"),
    )


REQUESTS_SQL = f"""
asked AS (SELECT DISTINCT p_name || ' ' || p_type || ' LLC' AS account_name FROM orders JOIN part ON o_custkey = p_partkey),
asked_keys AS (SELECT account_name, {sql_match("account_name")} AS k FROM asked),
requests AS (
  SELECT a.k, a.account_name AS ACCOUNT_NAME, CAST(date_trunc('year', o_orderdate) AS DATE) AS TERM_EFFCTV_DATE, o_orderpriority AS NEW_RENEWAL, o_orderstatus AS STATUS
  FROM orders JOIN part ON o_custkey = p_partkey JOIN asked_keys a ON a.account_name = p_name || ' ' || p_type || ' LLC'
  QUALIFY row_number() OVER (PARTITION BY a.k, date_trunc('year', o_orderdate) ORDER BY CAST(o_orderdate AS DATE) DESC NULLS FIRST, a.account_name DESC, o_orderstatus DESC, o_orderpriority DESC) = 1)"""


@query(f"WITH {REQUESTS_SQL} SELECT k AS ENTITY_FOR_TEXT_MATCHING, ACCOUNT_NAME, TERM_EFFCTV_DATE, NEW_RENEWAL, STATUS FROM requests")
def request_list(spark, sf):
    return linkage.request_list(_requests(spark, sf)).drop("MDFD_DATE")


def _master(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    day, st = F.to_date("o_orderdate"), F.col("o_orderstatus")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").cast("string").alias("ORGNZTN_IDNTFR"), F.col("c_name").alias("ORGNZTN_NAME"), F.col("c_mktsegment").alias("OPRTNS_DSCRPTN"),
        F.col("o_orderpriority").alias("PRDCT_SHRT_NAME"), day.alias("PLAN_EFFCTV_DATE"), F.date_add(day, 365).alias("PLAN_EXPRTN_DATE"),
        F.date_add(day, 30).alias("VLTN_DATE"), F.lit("Carrier").alias("CRRNT_CRRR_ORGNZTN_NAME"),
        F.when(st == "P", F.concat(F.lit("Part-"), F.col("o_custkey").cast("string"))).otherwise(F.concat(F.lit("CLM "), F.col("o_orderkey").cast("string"))).alias("CLM_IDNTFR"),
        st.alias("CLM_STTS_INDCTR"), day.alias("ACCDNT_DATE"), F.lit("fell").alias("ACCDNT_DSCRPTN"), F.col("o_totalprice").alias("TTL_INCRRD_AMNT"),
        F.lit("CT").alias("STT_ABBRVTN"), F.lit("New").alias("CNSMR_RQST_DSCRPTN"), F.lit("DECLINED").alias("STTS_NAME"),
        F.trunc("o_orderdate", "year").alias("TERM_EFFCTV_DATE"), F.date_add(F.trunc("o_orderdate", "year"), 365).alias("TERM_EXPRTN_DATE"),
    )


SHOWN = (
    "CLM_IDNTFR", "CLAIM_NUMBER", "ACCIDENT_DATE", "TERM_EFFCTV_DATE", "VALUATION_DATE", "POLICY_EFFECTIVE_DATE", "TOTAL_INCURRED", "CLAIM_STATUS", "ENTITY_FINAL",
    "STATUS", "NEW_RENEWAL", "ACCOUNT_NAME", "ENTITY_FOR_TEXT_MATCHING", "IS_SHEET", "IS_MASTER", "ORGNZTN_IDNTFR", "PRODUCT", "CARRIER", "RECORD_INSERTION_DATE",
)

LAST = "QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY VALUATION_DATE DESC NULLS FIRST, {ties}) = 1"
SHEET_TIES = ", ".join(f"{c} DESC NULLS FIRST" for c in ("CLAIM_STATUS", "CLAIMANT_NAME", "TOTAL_INCURRED", "ENTITY", "EMAIL_FULL_SUBJECT_LINE", "sub"))


SHARED_SQL = f"""{SHEETS_SQL}, {REQUESTS_SQL},
lefts AS (SELECT DISTINCT k AS key, {sql_match("k")} AS name FROM (SELECT DISTINCT k FROM sheets)),
l AS (SELECT DISTINCT name FROM lefts WHERE name <> ''), r AS (SELECT DISTINCT k AS name FROM requests),
pairs AS (SELECT l.name, r.name AS r, length(l.name) + length(r.name) AS s, length(l.name) + length(r.name) - 2 * ({LCS}) AS d FROM l JOIN r ON length(r.name) BETWEEN length(l.name) - 5 AND length(l.name) + 5),
best AS (SELECT * FROM pairs WHERE round_even(100.0::DOUBLE * (s - d) / s, 0) > 90 QUALIFY row_number() OVER (PARTITION BY name ORDER BY round_even(100.0::DOUBLE * (s - d) / s, 0) DESC, d * 1.0 / s, r) = 1),
master0 AS (SELECT CAST(c_custkey AS VARCHAR) AS ORGNZTN_IDNTFR, c_name AS ORGNZTN_NAME, o_orderpriority AS PRDCT, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS st, o_totalprice AS amt,
  CASE WHEN o_orderstatus = 'P' THEN 'Part-' || CAST(o_custkey AS VARCHAR) ELSE 'CLM ' || CAST(o_orderkey AS VARCHAR) END AS CLM, CAST(date_trunc('year', o_orderdate) AS DATE) AS term
  FROM orders JOIN customer ON o_custkey = c_custkey),
master AS (SELECT *, array_to_string(list_sort(regexp_split_to_array(upper(CLM), '\\W+')), ' ') AS jk FROM master0
  QUALIFY row_number() OVER (PARTITION BY CLM, day, term ORDER BY ORGNZTN_IDNTFR DESC, ORGNZTN_NAME DESC, PRDCT DESC, amt DESC) = 1)"""


def linked_sql(run: str, new: str, old: str, today: str) -> str:
    """The tables of one run, named after it: sheets that satisfy ``new`` linked with those that satisfy ``old`` and with the master."""
    return f"""
now{run} AS (SELECT s.* EXCLUDE (k), b.r AS m, q.ACCOUNT_NAME, q.TERM_EFFCTV_DATE, q.NEW_RENEWAL, q.STATUS FROM sheets s LEFT JOIN lefts f ON s.k = f.key LEFT JOIN best b ON f.name = b.name LEFT JOIN requests q ON b.r = q.k WHERE {new}),
old{run} AS (SELECT s.* FROM sheets s WHERE {old} {LAST.format(keys="k, CLAIM_NUMBER, ACCIDENT_DATE, POLICY_EFFECTIVE_DATE", ties=SHEET_TIES)}),
before{run} AS (SELECT o.* EXCLUDE (k), b.r AS m, q.ACCOUNT_NAME, q.TERM_EFFCTV_DATE, q.NEW_RENEWAL, q.STATUS FROM old{run} o JOIN lefts f ON o.k = f.key JOIN best b ON f.name = b.name JOIN requests q ON b.r = q.k),
recent{run} AS (SELECT * FROM (SELECT * FROM now{run} UNION ALL SELECT * FROM before{run})
  WHERE (VALUATION_DATE >= TERM_EFFCTV_DATE - 365 AND VALUATION_DATE <= TERM_EFFCTV_DATE) OR TERM_EFFCTV_DATE IS NULL OR VALUATION_DATE IS NULL),
ours{run} AS (SELECT * FROM recent{run} {LAST.format(keys="m, CLAIM_NUMBER, ACCIDENT_DATE, POLICY_EFFECTIVE_DATE, TERM_EFFCTV_DATE", ties=SHEET_TIES)}),
keyed{run} AS (SELECT *, array_to_string(list_sort(regexp_split_to_array(upper(CASE WHEN CLAIM_NUMBER IN (SELECT CLM FROM master) THEN CLAIM_NUMBER ELSE CLAIMANT_NAME END), '\\W+')), ' ') AS jk FROM ours{run}),
merged{run} AS (SELECT a.*, a.jk IS NOT NULL AS has_a, b.CLM, b.day, b.term, b.st, b.amt, b.ORGNZTN_IDNTFR, b.ORGNZTN_NAME, b.PRDCT, b.jk AS bjk
  FROM keyed{run} a FULL JOIN master b ON a.jk IS NOT DISTINCT FROM b.jk AND a.ACCIDENT_DATE IS NOT DISTINCT FROM b.day AND a.TERM_EFFCTV_DATE IS NOT DISTINCT FROM b.term
   AND a.VALUATION_DATE IS NOT DISTINCT FROM b.day + 30),
linked{run} AS (SELECT coalesce(CLAIM_NUMBER, CLAIMANT_NAME, CLM) AS CLM_IDNTFR, CLAIM_NUMBER, coalesce(ACCIDENT_DATE, day) AS ACCIDENT_DATE, CASE WHEN has_a THEN TERM_EFFCTV_DATE ELSE term END AS TERM_EFFCTV_DATE,
 CASE WHEN has_a THEN VALUATION_DATE ELSE day + 30 END AS VALUATION_DATE, coalesce(POLICY_EFFECTIVE_DATE, day) AS POLICY_EFFECTIVE_DATE, coalesce(TOTAL_INCURRED, amt) AS TOTAL_INCURRED,
 coalesce(CLAIM_STATUS, st) AS CLAIM_STATUS, upper(coalesce(ORGNZTN_NAME, ENTITY, sub)) AS ENTITY_FINAL, coalesce(STATUS, CASE WHEN bjk IS NOT NULL THEN 'DECLINED' END) AS STATUS,
 coalesce(NEW_RENEWAL, CASE WHEN bjk IS NOT NULL THEN 'New' END) AS NEW_RENEWAL, ACCOUNT_NAME, m AS ENTITY_FOR_TEXT_MATCHING, CASE WHEN has_a THEN 1::BIGINT END AS IS_SHEET,
 CASE WHEN bjk IS NOT NULL THEN 1::BIGINT END AS IS_MASTER, ORGNZTN_IDNTFR, PRDCT AS PRODUCT, CASE WHEN bjk IS NOT NULL THEN 'Carrier' END AS CARRIER,
 CASE WHEN has_a THEN DATE '{today}' END AS RECORD_INSERTION_DATE, EMAIL_FULL_SUBJECT_LINE AS line, CLAIMANT_NAME AS who FROM merged{run})"""


@query(f"WITH {SHARED_SQL}, {linked_sql('0', 'is_new', 'NOT is_new', TODAY)} SELECT {', '.join(SHOWN)} FROM linked0")
def linkage_history(spark, sf):
    new, old = _tagged(spark, sf)
    out = linkage.loss_history_linkage(new, old, _requests(spark, sf), _master(spark, sf), F.lit(TODAY))
    return out.select(*SHOWN)


FIRST_RUN = "1997-01-01"
SHEET_ROWS = 50_000  # of one file: a file is one record in the task that reads it, so more rows make more files, not longer ones
OLD_WINDOW = f"NOT is_new AND VALUATION_DATE BETWEEN DATE '{FIRST_RUN}' - 396 AND DATE '{FIRST_RUN}' + 91"
SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in (*SHOWN, "line", "who") if c != "RECORD_INSERTION_DATE")


@query(f"""WITH {SHARED_SQL}, {linked_sql("1", "NOT is_new", "false", FIRST_RUN)}, {linked_sql("2", "is_new", OLD_WINDOW, TODAY)}
SELECT {', '.join(SHOWN)}, 0::BIGINT AS batch FROM linked1 UNION ALL
SELECT {', '.join(SHOWN)}, 1::BIGINT AS batch FROM linked2 a WHERE NOT EXISTS (SELECT 1 FROM linked1 b WHERE {SAME})""")
def linkage_runs(spark, sf):
    """The whole chain twice, from files: the first sheets start the history, the second batch of files adds to it what is new."""
    inbox, home = scratch_path(spark, "inbox"), scratch_path(spark, "linkage")
    sheets = _sheets(spark, sf)
    requests, master = _requests(spark, sf), _master(spark, sf)
    for part, today in (("NOT is_new", FIRST_RUN), ("is_new", TODAY)):
        sheets.filter(part).drop("is_new").write.mode("append").option("maxRecordsPerFile", SHEET_ROWS).csv(inbox, header=True)
        linkage.run(spark, inbox, home, requests, master, F.lit(today))
    return linkage.read_history(spark, home).select(*SHOWN, "batch")
