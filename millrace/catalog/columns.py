"""Column and filter queries: text, dates, casts, conformance."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.registry import query, table
from millrace.functions import dates, text, values
from millrace.operators import filters, shape

FOLD = "regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g')"


def upper_sql(col: str) -> str:
    """Upper case with the sharp s spelled out, as Java and Python do."""
    return f"upper(replace({col}, 'ß', 'SS'))"


def sql_steps(start: str, steps) -> str:
    expr = start
    for pattern, to in steps:
        quoted = pattern.replace("'", "''")
        expr = f"regexp_replace({expr}, '{quoted}', '{to}', 'g')"
    return expr


def sql_account(col: str) -> str:
    cleaned = sql_steps(f"upper({FOLD.format(upper_sql(col))})", text.ACCOUNT_STEPS)
    return f"(SELECT nullif(CASE WHEN upper(x) NOT IN ('NONE', 'NAN') THEN x END, '') FROM (SELECT {cleaned} AS x))"


def sql_match(col: str) -> str:
    words = "|".join(sorted(text.LEGAL_WORDS, key=lambda w: (-len(w), w)))
    head = f"regexp_replace({sql_account(col)}, '^((?s:.)*) - [^\\n]*\\z', '\\1')"
    steps = [(r"\([^()]*\)", ""), (r"[^\w\s]", ""), (r" +", " "), (rf"\b({words})\b", ""), (r" +", " "), (r"^ ", ""), (r" \z", "")]
    return f"(SELECT nullif(CASE WHEN upper(x) NOT IN ('NONE', 'NAN') THEN x END, '') FROM (SELECT {sql_steps(head, steps)} AS x))"


NAMES = """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'RE: National Account ' WHEN '2-HIGH' THEN 'FW: Accounts  ' WHEN '3-MEDIUM' THEN 'Submission - ' ELSE '' END
  || p_name || CASE o_orderstatus WHEN 'F' THEN ' Holdings, Inc. - Loss Run ' WHEN 'O' THEN ' Services (' || p_type || ') LLC - ' || p_brand || ' ' ELSE ' Café Corp ' END
  || strftime(o_orderdate, '%m/%d/%Y') AS name
FROM orders JOIN part ON o_custkey = p_partkey"""


def _names(spark, sf):
    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    head = F.when(pri == "1-URGENT", "RE: National Account ").when(pri == "2-HIGH", "FW: Accounts  ").when(pri == "3-MEDIUM", "Submission - ").otherwise("")
    tail = (
        F.when(st == "F", " Holdings, Inc. - Loss Run ")
        .when(st == "O", F.concat(F.lit(" Services ("), F.col("p_type"), F.lit(") LLC - "), F.col("p_brand"), F.lit(" "))).otherwise(" Café Corp ")
    )
    o, p = table(spark, sf, "orders"), table(spark, sf, "part")
    return o.join(p, F.col("o_custkey") == F.col("p_partkey")).select(
        "o_orderkey", F.concat(head, "p_name", tail, F.date_format("o_orderdate", "MM/dd/yyyy")).alias("name")
    )


@query(f"WITH n AS ({NAMES}) SELECT o_orderkey, {sql_account('name')} AS account FROM n")
def account_names(spark, sf):
    return text.clean_account(_names(spark, sf), "name", out="account").drop("name")


@query(f"WITH n AS ({NAMES}) SELECT o_orderkey, {sql_match('name')} AS match_key FROM n")
def match_keys(spark, sf):
    return text.match_key(_names(spark, sf), "name", out="match_key").drop("name")


@query(f"SELECT doc_id, md5({sql_account('text')}) AS account_md5, length({sql_account('text')}) AS n FROM documents")
def name_clean(spark, sf):
    """The account-name cleaner over whole documents."""
    out = text.clean_account(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return out.select("doc_id", F.md5("text").alias("account_md5"), F.length("text").cast("long").alias("n"))


@query(f"""
WITH t AS (SELECT doc_id, list_sort(list_filter(regexp_split_to_array(upper({FOLD.format(upper_sql('text'))}), '\\W+'), lambda w: w <> '')) AS w FROM documents)
SELECT doc_id, md5(array_to_string(w, ' ')) AS key_md5, CAST(len(w) AS BIGINT) AS n_words FROM t""")
def token_key(spark, sf):
    out = text.token_key(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return out.select("doc_id", F.md5("text").alias("key_md5"), F.size(F.split("text", " ")).cast("long").alias("n_words"))


@query(f"SELECT doc_id, md5({FOLD.format('text')}) AS folded_md5, CAST(length({FOLD.format('text')}) AS BIGINT) AS n FROM documents")
def ascii_fold(spark, sf):
    out = text.ascii_fold(table(spark, sf, "documents").select("doc_id", "text"), ["text"])
    return out.select("doc_id", F.md5("text").alias("folded_md5"), F.length("text").cast("long").alias("n"))


@query("SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '([-+]?\\d*\\.\\d+|\\d+)', 1), '') AS DOUBLE) AS props_no FROM events")
def first_number(spark, sf):
    return text.first_number(table(spark, sf, "events").select("event_id", F.col("props").alias("props_no")), ["props_no"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS found FROM orders""")
def first_date(spark, sf):
    st, d = F.col("o_orderstatus"), F.col("o_orderdate")
    note = (
        F.when(st == "F", F.concat(F.lit("closed "), F.date_format(d, "M/d/yyyy"), F.lit(" by 3")))
        .when((st == "O") & (F.col("o_orderpriority") == "1-URGENT"), F.concat(F.lit("short "), F.date_format(d, "M-d-yy")))
        .when((st == "O") & (F.col("o_orderpriority") == "2-HIGH") & (F.dayofmonth(d) > 12), F.concat(F.lit("day first "), F.date_format(d, "d/M/yyyy")))
        .when(st == "O", F.concat(F.lit("as of "), F.date_format(d, "yyyy-MM-dd"))).when(F.col("o_orderpriority") == "5-LOW", F.date_format(d, "M/d/yy")).otherwise(F.concat(F.lit("bad 13/45/"), F.year(d)))
    )
    return text.first_date(table(spark, sf, "orders").select("o_orderkey", note.alias("found")), ["found"])


@query("""
SELECT n_nationkey, trim(replace(regexp_replace(regexp_replace(split_part(r, '-', 1), '\\s', '', 'g'), '\\(Rural\\)|\\(Urban\\)|Rural|Urban', '', 'g'), '/', '-')) AS market FROM (
 SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN n_name || ' / Coast (Rural) - x' WHEN n_regionkey = 1 THEN n_name || ' (Urban)' WHEN n_regionkey = 2 THEN n_name || ' Rural - y' ELSE n_name END AS r FROM nation)""")
def market_from_region(spark, sf):
    name, key = F.col("n_name"), F.col("n_regionkey")
    region = (
        F.when(key == 0, F.concat(name, F.lit(" / Coast (Rural) - x"))).when(key == 1, F.concat(name, F.lit(" (Urban)")))
        .when(key == 2, F.concat(name, F.lit(" Rural - y"))).otherwise(name)
    )
    return text.market_from_region(table(spark, sf, "nation").select("n_nationkey", region.alias("r")), "r").drop("r")


@query("""
SELECT p_partkey, trim(regexp_replace(replace(regexp_replace(n, '(?i)\\((tbr|nw|na|v)\\)', '', 'g'), '_', ' '), ' +', ' ', 'g')) AS channel FROM (
 SELECT p_partkey, replace(p_name, ' ', '_') || CASE WHEN p_size > 25 THEN ' (TBR)' ELSE '(v)' END AS n FROM part)""")
def tidy_names(spark, sf):
    n = F.concat(F.regexp_replace("p_name", " ", "_"), F.when(F.col("p_size") > 25, " (TBR)").otherwise("(v)"))
    return text.tidy_names(table(spark, sf, "part").select("p_partkey", n.alias("channel")), "channel")


@query("SELECT c_custkey, substr(c_name, 1, 4) || ' ' || substr(c_name, 6, 6) AS c_name FROM customer")
def id_reformat(spark, sf):
    return text.reformat_id(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name")


@query("""
SELECT conv_id, turn, rtrim(replace(replace(text, chr(10), ' '), ',', ' '), ' ') AS text FROM conversations""")
def scrub(spark, sf):
    return text.scrub(table(spark, sf, "conversations").select("conv_id", "turn", "text"), ["text"], drop_commas=True)


@query("""
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, '') || coalesce(CAST(o_custkey AS VARCHAR), '') AS joined,
CASE WHEN o_orderstatus = 'O' THEN NULL ELSE coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, '') || ',' || CAST(o_custkey AS VARCHAR) END AS person,
'860 ' || CAST(o_custkey AS VARCHAR) || ' ' || CAST(o_orderkey AS VARCHAR) || ' ' || CASE WHEN o_orderstatus <> 'P' THEN 'x' || o_orderpriority ELSE '' END AS phone FROM orders""")
def joined_text(spark, sf):
    st = F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(st != "P", F.col("o_orderpriority")).alias("ext"), F.col("o_custkey").cast("string").alias("cust"), F.lit("860").alias("area"),
        F.col("o_orderkey").cast("string").alias("number"),
        F.when(st != "O", F.when(st != "P", F.col("o_orderpriority"))).alias("last"), F.when(st != "O", F.col("o_custkey").cast("string")).alias("first"),
    )
    rows = text.phone_text(text.person_name(text.join_text(rows, "joined", "ext", "cust"), "last", "first", "person"), ["area", "cust", "number", "ext"], "phone")
    return rows.select("o_orderkey", "joined", "person", "phone")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed, NULL::DATE AS unparsed, strftime(o_orderdate, '%m/%d/%Y') AS shown,
CAST(quarter(o_orderdate) AS VARCHAR) || 'Q' || CAST(year(o_orderdate) AS VARCHAR) AS quarter FROM orders""")
def parse_dates(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("parsed"), F.date_format("o_orderdate", "dd MMMM").alias("unparsed"), F.to_date("o_orderdate").alias("shown"),
    )
    out = dates.parse_dates(dates.quarter_label(o, "shown", "quarter"), ["parsed", "unparsed"])
    return dates.format_dates(out, ["shown"])


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(o_orderdate AS DATE) AS a, CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS b
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT *, CAST(CASE WHEN b IS NOT NULL THEN least(date_diff('day', a, b), 100) END AS INTEGER) AS days FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, days, l_extendedprice * (365.0::DOUBLE / nullif(CAST(days AS DOUBLE), 0)) AS yearly FROM d""")
def term_days(spark, sf):
    t = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("yearly"), F.to_date("o_orderdate").alias("a"),
        F.when(F.col("l_returnflag") != "N", F.to_date("l_shipdate")).alias("b"),
    )
    return dates.annualise(dates.term_days(t, "a", "b", 100, "days"), ["yearly"], "days").drop("a", "b")


@query("""
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CASE WHEN d = last_day(d) THEN last_day(CAST(d + INTERVAL 12 MONTH AS DATE)) ELSE CAST(d + INTERVAL 12 MONTH AS DATE) END AS year_on,
CASE WHEN d = last_day(d) THEN last_day(CAST(d - INTERVAL 3 MONTH AS DATE)) ELSE CAST(d - INTERVAL 3 MONTH AS DATE) END AS quarter_back,
d + 365 AS fixed_year, d - 396 AS fixed_13, d + 91 AS fixed_3 FROM t""")
def shift_months(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    for n, mode, out in ((12, "calendar", "year_on"), (-3, "calendar", "quarter_back"), (12, "fixed", "fixed_year"), (-13, "fixed", "fixed_13"), (3, "fixed", "fixed_3")):
        t = dates.shift_months(t, "d", n, mode, out)
    return t.drop("d")


@query("""
SELECT event_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_diff, strftime(ts, '%a') AS weekday,
CASE WHEN hour(ts) >= 6 AND hour(ts) < 10 THEN 'Morning' WHEN hour(ts) >= 10 AND hour(ts) < 17 THEN 'Daytime' WHEN hour(ts) >= 17 AND hour(ts) < 23 THEN 'Primetime'
 WHEN hour(ts) >= 23 OR hour(ts) < 2 THEN 'Latenight' ELSE 'Overnight' END AS day_part,
CASE WHEN value <= 90 THEN 'Startperiod' WHEN value >= 275 THEN 'Endperiod' END AS term_phase,
CASE WHEN hour(ts) >= 18 AND hour(ts) < 23 THEN 'Prime' ELSE 'Non Prime' END AS pt_npt, time_bucket(INTERVAL 30 MINUTE, ts) AS slot_start,
strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%H:%M') || '-' || strftime(time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE, '%H:%M') AS timeband FROM events""")
def day_parts(spark, sf):
    e = table(spark, sf, "events").withColumn("start", F.lit("2024-01-01").cast("date"))
    e = dates.day_part(dates.weekday(dates.day_gap(e, "ts", "start"), "ts"), "ts")
    e = dates.slot_of(dates.prime_flag(dates.term_phase(e, "value"), "ts"), "ts")
    return e.select("event_id", "day_diff", "weekday", "day_part", "term_phase", "pt_npt", "slot_start", "timeband")


@query("""
SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts_utc, make_timestamp(epoch_us(ts) // 1000 * 1000) + INTERVAL 330 MINUTE AS ts_local FROM events""")
def to_local(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return dates.to_local(e, "ms").drop("ms")


@query("SELECT o_orderkey, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def month_of_text(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy/MM/dd").alias("day"))
    return dates.month_of_text(o, "day").drop("day")


@query("""
SELECT event_id, CASE event_type WHEN 'signup' THEN 'join' ELSE event_type END AS event_type, coalesce(CASE WHEN value > 300 THEN 'big' END, CASE WHEN value > 200 THEN 'mid' END, 'small') AS size,
CASE WHEN value < 10 THEN CASE WHEN event_type = 'click' THEN 'A' ELSE 'B' END WHEN value < 100 THEN 'C' ELSE 'D' END AS grade,
round(value, 1) AS rounded, ceil(value) AS up, round(value * 100 / 351.5, 2) AS pct FROM events""")
def case_rules(spark, sf):
    v = F.col("value")
    e = table(spark, sf, "events").withColumns({"big": F.when(v > 300, "big"), "mid": F.when(v > 200, "mid")})
    e = values.fill_chain(text.recode(e, "event_type", {"signup": "join"}, out="recoded"), "size", "big", "mid", default="small")
    e = values.case_of(e, [((v < 10) & (F.col("event_type") == "click"), "A"), (v < 10, "B"), (v < 100, "C")], "grade", "D")
    e = values.round_to(e.withColumn("rounded", v), ["rounded"], 1)
    return e.select(
        "event_id", F.col("recoded").alias("event_type"), "size", "grade", "rounded", F.ceil(v).cast("double").alias("up"), values.percent(v, F.lit(351.5)).alias("pct")
    )


@query("""
SELECT event_id, CAST(split_part(m, ':', 1) AS VARCHAR) AS cpu_text, CAST(trunc(CAST(split_part(m, ':', 2) AS DOUBLE)) AS INTEGER) AS mem_whole
FROM (SELECT event_id, CAST(user_id AS VARCHAR) || ':' || CAST(value AS VARCHAR) AS m FROM events)""")
def split_part(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.concat_ws(":", F.col("user_id").cast("string"), F.col("value").cast("string")).alias("m"))
    e = text.split_part(text.split_part(e, "m", ":", 0, "cpu_text"), "m", ":", 1, "mem_whole", as_int=True)
    return e.drop("m")


@query("SELECT o_orderkey, format('{:,.5f}', o_totalprice) AS shown FROM orders")
def display_number(spark, sf):
    return text.display_number(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 5, out="shown").drop("o_totalprice")


@query("""
WITH t AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS tags FROM events GROUP BY 1)
SELECT user_id, array_to_string(tags, ',') AS tags_text, CAST(d.code AS INTEGER) AS tags_code FROM t LEFT JOIN
 (SELECT event_type, length(event_type) AS code FROM events GROUP BY 1) d ON tags[1] = d.event_type""")
def flatten_array(spark, sf):
    e = table(spark, sf, "events")
    tags = e.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("tags"))
    codes = e.select("event_type").distinct().select("event_type", F.length("event_type").alias("code"))
    return text.flatten_array(tags, "tags", codes).drop("tags")


@query("""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND (o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '2-HIGH'))
AND (CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) <> '5-LOW' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def row_filters(spark, sf):
    o = table(spark, sf, "orders").withColumn("pri", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    o = o.filter(F.col("o_totalprice").between(1000, 200000) & ((F.col("o_orderstatus") == "F") | F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")))
    return filters.in_year(filters.not_equal(o, "pri", "5-LOW"), "o_orderdate", 1997).select("o_orderkey", "o_orderstatus")


@query("""
SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND contains(o_orderpriority, 'IG') AND upper(trim(' ' || lower(o_orderstatus))) = 'F'""")
def member_filters(spark, sf):
    rich = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select("c_custkey")
    o = filters.contains(filters.is_any(table(spark, sf, "orders"), "o_custkey", rich), "o_orderpriority", "IG")
    return o.filter(filters.same_text(F.concat(F.lit(" "), F.lower("o_orderstatus")), "f")).select("o_orderkey")


@query("""
SELECT o_orderkey, n FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CASE WHEN o_orderstatus = 'F' THEN '(DNU) ' WHEN o_totalprice > 400000 THEN 'DNU-' WHEN o_totalprice > 350000 THEN '{DNU ' ELSE '' END
  || o_orderpriority END AS n FROM orders)
WHERE NOT (n LIKE '{DNU%' OR n LIKE '%{%DNU%}%' OR n LIKE '%*%DNU%*%' OR n LIKE '%(%DNU%)%' OR n LIKE '%DNU-%' OR n LIKE '%-DNU%' OR n LIKE '%- DNU' OR n LIKE '%DNU- %')""")
def exclude_like(spark, sf):
    head = F.when(F.col("o_orderstatus") == "F", "(DNU) ").when(F.col("o_totalprice") > 400000, "DNU-").when(F.col("o_totalprice") > 350000, "{DNU ").otherwise("")
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.concat(head, "o_orderpriority")).alias("n"))
    return filters.exclude_like(o, "n")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND instr('1-URGENT,2-HIGH', o_orderpriority) > 0")
def optional_filter(spark, sf):
    o = filters.optional_filter(table(spark, sf, "orders"), "o_orderstatus", "F")
    o = filters.optional_filter(filters.optional_filter(o, "o_orderpriority", "ALL"), "o_custkey", None)
    return filters.optional_filter(o, "o_orderpriority", "1-URGENT,2-HIGH", within=True).select("o_orderkey")


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'N' THEN CAST(o_orderdate AS DATE) END AS v, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + 300 END AS t
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT * FROM t WHERE (v >= t - 365 AND v <= t) OR t IS NULL OR v IS NULL""")
def within_lookback(spark, sf):
    t = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") != "N", F.to_date("o_orderdate")).alias("v"),
        F.when(F.col("l_linestatus") == "F", F.date_add(F.to_date("l_shipdate"), 300)).alias("t"),
    )
    return filters.within_lookback(t, "v", "t")


@query("""
SELECT CAST(p_partkey AS BIGINT) AS PART_KEY, p_name AS NAME_OF_PART, CAST(p_retailprice AS DOUBLE) AS RETAIL_PRICE, NULL::DATE AS LAST_SEEN, CAST(regexp_extract(p_brand, '\\d+', 0) AS BIGINT) AS BRAND FROM part""")
def conform_types(spark, sf):
    """All-text input with loose headers, brought to a declared schema."""
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Part Key"), F.col("p_name").alias("Name of Part"),
        F.concat(F.lit("USD "), F.col("p_retailprice").cast("string")).alias("Retail Price"), F.col("p_brand").alias("brand"),
    )
    want = T.StructType([
        T.StructField("PART_KEY", T.LongType()), T.StructField("NAME_OF_PART", T.StringType()), T.StructField("RETAIL_PRICE", T.DoubleType()),
        T.StructField("LAST_SEEN", T.DateType()), T.StructField("BRAND", T.LongType()),
    ])
    return shape.conform(shape.normalise_names(raw), want)


@query("""
SELECT c_custkey AS key, upper(c_mktsegment) AS segment, CAST(c_acctbal AS DECIMAL(16,6))::DOUBLE AS balance, nullif(c_mktsegment, 'FURNITURE') AS theme, 1 AS is_listed, NULL::VARCHAR AS promo FROM customer""")
def shape_columns(spark, sf):
    """Rename, cast, constants, typed nulls, sentinel to null, drop."""
    c = shape.rename(table(spark, sf, "customer"), {"c_custkey": "key", "c_acctbal": "balance", "c_mktsegment": "segment"})
    c = shape.null_if(c.withColumns({"theme": F.col("segment"), "segment": F.upper("segment")}), ["theme"], "FURNITURE")
    c = shape.constants(c, {"is_listed": 1, "promo": None}, {"promo": "string"})
    return shape.cast_all(shape.cast_all(c, {"balance": "decimal(16,6)"}), {"balance": "double"}).drop("c_name", "c_nationkey")


@query("SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def sql_views(spark, sf):
    """SQL text over registered frames."""
    shape.register(table(spark, sf, "supplier"), "millrace_supplier")
    shape.register(table(spark, sf, "nation"), "millrace_nation")
    return spark.sql(
        "SELECT s_suppkey, s_name, n_name FROM millrace_supplier JOIN millrace_nation ON s_nationkey = n_nationkey"
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag IN (SELECT l_returnflag FROM lineitem GROUP BY 1 HAVING count(*) > 10)")
def approved_list(spark, sf):
    li = table(spark, sf, "lineitem")
    approved = li.groupBy("l_returnflag").count().filter(F.col("count") > 10)
    return filters.keep_listed(li, approved, "l_returnflag").select("l_orderkey", "l_linenumber", "l_partkey")
