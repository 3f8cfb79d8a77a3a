"""Source and sink queries: each writes a whole table in some form and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.registry import query, table
from millrace.session import scratch_path
from millrace.sources import files, tables


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"
EVENTS = "SELECT event_id, user_id, event_type, props, CAST(ts AS DATE) AS day FROM events"


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "props", F.to_date("ts").alias("day"))


@query(f"SELECT * FROM ({EVENTS}) WHERE day >= DATE '2024-01-10' AND day < DATE '2024-01-20'")
def partition_pruning(spark, sf):
    """Partitioned ORC, then a filter on the partition column."""
    path = scratch_path(spark, "orc")
    files.write_partitioned(_events(spark, sf), path, ["day"])
    back = spark.read.orc(path).filter((F.col("day") >= F.lit("2024-01-10").cast("date")) & (F.col("day") < F.lit("2024-01-20").cast("date")))
    return back.select("event_id", "user_id", "event_type", "props", "day")


@query(f"""
SELECT event_id, user_id, event_type, props, day FROM ({EVENTS}) WHERE day < DATE '2024-01-15'
UNION ALL SELECT event_id, user_id, 'late ' || event_type, props, day FROM ({EVENTS}) WHERE day >= DATE '2024-01-15'""")
def partition_overwrite(spark, sf):
    """Only the days present in the second write are replaced."""
    path, e = scratch_path(spark, "days"), _events(spark, sf)
    files.write_partitioned(e, path, ["day"])
    late = e.filter(F.col("day") >= F.lit("2024-01-15").cast("date")).withColumn("event_type", F.concat(F.lit("late "), "event_type"))
    files.overwrite_partitions(late, path, ["day"])
    return spark.read.orc(path).select("event_id", "user_id", "event_type", "props", "day")


@query(EVENTS)
def csv_round_trip(spark, sf):
    """Quoted text with separators and quotes inside."""
    path, e = scratch_path(spark, "csv"), _events(spark, sf)
    e.write.option("quote", '"').option("escape", "\\").csv(path, header=True)
    return files.read_csv(spark, path, e.schema)


@query(f"SELECT * FROM ({EVENTS}) WHERE event_type <> 'error'")
def json_bad_rows(spark, sf):
    """JSON lines where every 'error' line is malformed: those are skipped."""
    path, e = scratch_path(spark, "json"), _events(spark, sf)
    line = F.to_json(F.struct(*e.columns))
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), line)).otherwise(line)
    e.select(text.alias("value")).write.text(path)
    return files.read_json(spark, path, e.schema)


@query("""
WITH t AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS tags, count(*) AS n FROM events GROUP BY 1) SELECT user_id, array_to_string(tags, '|') AS tags, n FROM t""")
def json_arrays(spark, sf):
    """Nested arrays survive a JSON round trip."""
    path = scratch_path(spark, "nested")
    t = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("tags"), F.count("*").alias("n"))
    files.write_json(t, path)
    return files.read_json(spark, path, t.schema, on_bad="fail").withColumn("tags", F.array_join("tags", "|"))


LAYOUT = [("p_partkey", 1, 12, "bigint"), ("p_name", 13, 20, "string"), ("p_type", 33, 12, "string"), ("p_size", 45, 4, "int")]


@query("SELECT p_partkey, p_name, p_type, p_size FROM part")
def fixed_width(spark, sf):
    path = scratch_path(spark, "fixed")
    files.write_fixed(table(spark, sf, "part"), path, LAYOUT)
    return files.read_fixed(spark, path, LAYOUT)


@query("SELECT count(*) AS n FROM part WHERE contains(p_name, 'ring') OR contains(p_type, 'ring')")
def grep_lines(spark, sf):
    path = scratch_path(spark, "lines")
    files.write_fixed(table(spark, sf, "part"), path, LAYOUT)
    return files.grep(spark.read.text(path), "ring").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(16,6))::DOUBLE AS o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def raw_to_columnar(spark, sf):
    """Text in, typed and partitioned ORC out."""
    raw, path = scratch_path(spark, "raw"), scratch_path(spark, "typed")
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("year")).write.csv(raw, header=True)
    names = T.StructType([T.StructField(c, T.StringType()) for c in ("o_orderkey", "o_totalprice", "o_orderpriority", "year")])
    files.to_columnar(files.read_csv(spark, raw, names), {"o_orderkey": "bigint", "o_totalprice": "decimal(16,6)"}, ["year"], path)
    back = spark.read.orc(path)
    return back.select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority", "year")


@query(f"{ORDERS} UNION ALL {ORDERS} WHERE o_orderstatus = 'F'")
def insert_dynamic(spark, sf):
    """A partitioned table created from a query, then rows appended to the partitions they name."""
    name = f"millrace_{uuid.uuid4().hex}"
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    tables.materialise(o, name, path=scratch_path(spark, "table"), parts=["o_orderstatus"])
    tables.insert_dynamic(o.filter(F.col("o_orderstatus") == "F"), name)
    return spark.table(name)


@query(ORDERS)
def incremental_append(spark, sf):
    """Rows after the target's newest date, appended with their declared types."""
    path, o = scratch_path(spark, "target"), _orders(spark, sf)
    tables.append(o.filter(F.col("o_orderdate") <= F.lit("1998-06-30").cast("date")), o.schema, path)
    target = spark.read.parquet(path)
    tables.append(tables.incremental(o, target, "o_orderdate"), o.schema, path)
    return spark.read.parquet(path)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS \"Order No\", o_orderpriority AS \"Priority\", strftime(o_orderdate, '%m/%d/%Y') AS \"Eff.Date\" FROM orders")
def report_export(spark, sf):
    """A tab-separated report with titles."""
    path = scratch_path(spark, "report")
    o = table(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "MM/dd/yyyy"))
    files.write_report(o, [("o_orderkey", "Order No"), ("o_orderpriority", "Priority"), ("day", "Eff.Date")], path)
    return files.read_csv(spark, path, sep="\t")


@query("SELECT event_id, event_type, CAST(week(ts) AS INTEGER) AS week FROM events")
def weekly_export(spark, sf):
    """One CSV folder per week, read back by folder."""
    path = scratch_path(spark, "weeks")
    e = table(spark, sf, "events").select("event_id", "event_type", F.weekofyear("ts").alias("week"))
    files.export_csv(e, path, by="week")
    schema = T.StructType([*e.schema.fields, T.StructField("week_part", T.IntegerType())])
    return files.read_csv(spark, path, schema).drop("week_part")


@query("""
SELECT p_partkey AS PART_KEY, p_name AS NAME_OF_PART, CAST(p_size AS DOUBLE) AS SIZE_NO, 'a/sheet.csv' AS source_file FROM part WHERE p_size < 25
UNION ALL SELECT p_partkey, p_name, NULL, 'b/sheet.csv' FROM part WHERE p_size >= 25
UNION ALL SELECT p_partkey, p_name, CAST(p_size AS DOUBLE), 'a/turned.csv' FROM part""")
def ingest_files(spark, sf):
    """Files of different headers in one folder and of one name in two; each by its own header, tagged by path, doubled rows dropped."""
    root, p = scratch_path(spark, "drop"), table(spark, sf, "part")
    size = F.concat(F.lit("no. "), F.col("p_size").cast("string")).alias("Size No")
    a = p.filter(F.col("p_size") < 25).select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Name of Part"), size)
    b = p.filter(F.col("p_size") >= 25).select(F.col("p_name").alias("name of part"), F.col("p_partkey").alias("part key"), F.lit("x").alias("extra"))
    turned = p.select(size, F.col("p_name").alias("Name of Part"), F.lit("99999999999999999999").alias("other no"), F.col("p_partkey").alias("Part Key"))
    a.unionByName(a).write.csv(f"{root}/in/a/sheet.csv", header=True)
    turned.write.csv(f"{root}/in/a/turned.csv", header=True)
    b.write.csv(f"{root}/in/b/sheet.csv", header=True)
    schema = T.StructType([T.StructField("PART_KEY", T.LongType()), T.StructField("NAME_OF_PART", T.StringType()), T.StructField("SIZE_NO", T.DoubleType())])
    out = files.ingest_files(spark, [f"{root}/in/a/*", f"{root}/in/b/*"], schema)
    # Spark writes a folder of part files; the folder's name stands for the sheet's.
    return out.withColumn("source_file", F.regexp_extract("source_file", r"/in/(.*)/[^/]*$", 1)).dropDuplicates()


@query(ORDERS)
def compacted(spark, sf):
    """Many small files rewritten as few."""
    src, out, o = scratch_path(spark, "small"), scratch_path(spark, "compact"), _orders(spark, sf)
    o.repartition(16).write.parquet(src)
    files.compact(spark, src, out)
    return spark.read.parquet(out)


@query(f"SELECT moment, o.* FROM ({ORDERS}) o, (VALUES ('reader from before'), ('reader from after')) AS m(moment)")
def compacted_under_reader(spark, sf):
    """A published table compacted while a reader of the version before is still open; both read all rows."""
    root = scratch_path(spark, "published")
    files.publish(_orders(spark, sf).repartition(16), root)
    before = files.published(spark, root)
    files.compact_published(spark, root)
    after = files.published(spark, root)
    tag = lambda df, moment: df.select(F.lit(f"reader from {moment}").alias("moment"), "*")
    return tag(before, "before").unionByName(tag(after, "after"))


@query("""
SELECT c_custkey AS id, c_acctbal AS balance, NULL::BIGINT AS keys, 'auto' AS lob FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'gl' FROM supplier
UNION ALL SELECT p_partkey, NULL, NULL, 'prop' FROM part UNION ALL SELECT o_orderkey, NULL, o_custkey, 'wc' FROM orders""")
def subject_load(spark, sf):
    t = lambda n: table(spark, sf, n)
    return tables.load_subjects(spark, {
        "auto": t("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")),
        "gl": t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")),
        "prop": t("part").select(F.col("p_partkey").alias("id")),
        "wc": t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("keys")),
    })
