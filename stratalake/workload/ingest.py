"""Reading and writing landed files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import columns
from stratalake.session import scratch_path
from stratalake.sinks import tables
from stratalake.sources import documents, files
from stratalake.workload import query
from stratalake.workload.common import iso_dates, table, text

ORDER_SCHEMA = {
    "Order Key": {"target_name": "order_key", "type": "long"},
    "Order Date": {"target_name": "order_date", "type": "date", "format": "yyyyMMdd"},
    "Price": {"target_name": "price", "type": "decimal", "precision": "12,2"},
    "Customer": {"target_name": "customer", "type": "integer"},
    "Urgent": {"target_name": "urgent", "type": "boolean"},
    "Not There": {"target_name": "not_there", "type": "string"},
}


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text columns with dates good, badly formatted, blank, missing and ancient."""
    day = F.col("o_orderdate")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("Order Key"),
        F.when(priority == "5-LOW", F.concat(F.lit("1899"), F.date_format(day, "MMdd")))
        .when(priority == "4-NOT SPECIFIED", "   ")
        .when(status == "O", F.date_format(day, "yyyy-MM-dd"))
        .when(status == "P", F.date_format(day, "yyyyMMdd")).alias("Order Date"),
        F.when(priority == "3-MEDIUM", "n/a")
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("Price"),
        text("o_custkey").alias("Customer"),
        (priority == "1-URGENT").cast("string").alias("Urgent"),
        status.alias("Status"),
    )


RAW_ORDERS_SQL = """
raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k,
    CASE WHEN o_orderpriority = '5-LOW' THEN '1899' || strftime(o_orderdate, '%m%d')
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '   '
         WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y%m%d') END AS d,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'n/a'
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS p,
    CAST(o_custkey AS VARCHAR) AS c, o_orderpriority = '1-URGENT' AS u, o_orderstatus AS s
  FROM orders)
"""
TYPED_ORDERS_SQL = f"""
WITH {RAW_ORDERS_SQL}
SELECT TRY_CAST(k AS BIGINT) AS order_key,
  CASE WHEN TRY_CAST(try_strptime(d, '%Y%m%d') AS DATE) >= DATE '1900-01-01'
       THEN strftime(try_strptime(d, '%Y%m%d'), '%Y-%m-%d') END AS order_date,
  CAST(TRY_CAST(p AS DECIMAL(12,2)) AS VARCHAR) AS price,
  TRY_CAST(c AS INTEGER) AS customer, u AS urgent, s AS "Status", 'r1' AS meta_run_id
FROM raw
"""


@query("apply_schema_orders", TYPED_ORDERS_SQL)
def apply_schema_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = columns.apply_schema(raw_orders(spark, sf_dir), ORDER_SCHEMA)
    stamped = columns.stamp(typed, meta_run_id="r1")
    return iso_dates(stamped).withColumn("price", text("price"))


@query("read_delimited", TYPED_ORDERS_SQL)
def read_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a tab-separated drop, with the file found by its base name."""
    base = files.run_path(scratch_path(spark, "delimited"), "r1")
    raw_orders(spark, sf_dir).write.csv(base + "Order.txt", header=True, sep="\t", quoteAll=False)
    landed = files.match_files([base + "Order.txt", base + "readme.pdf"], {"ORDER.TXT": "orders"})
    mapping = {path[len(base):]: name for path, name in landed.items()}
    frames = files.load_delimited_set(spark, base, mapping, "r1", "\t", {"orders": ORDER_SCHEMA})
    return iso_dates(frames["orders"]).withColumn("price", text("price"))


@query("read_positional", """
SELECT CAST(l_orderkey AS VARCHAR) AS "KEY", CAST(l_linenumber AS VARCHAR) AS "LINE",
  '"' || l_returnflag AS "NOTE", CASE WHEN l_linestatus = 'O' THEN 'O' END AS "FLAG",
  '20240101_000000' AS meta_run_id, '01012024' AS meta_release_date
FROM lineitem
""")
def read_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a trailing delimiter and unbalanced quotes; one of two files has a layout."""
    folder = scratch_path(spark, "positional")
    lines = table(spark, sf_dir, "lineitem").select(F.concat(
        text("l_orderkey"), F.lit("|"), text("l_linenumber"), F.lit('|"'), "l_returnflag",
        F.lit("|"), F.when(F.col("l_linestatus") == "O", "O").otherwise(""), F.lit("|"),
    ).alias("value"))
    lines.write.text(f"{folder}/LINES.RRF")
    frames = files.load_positional_set(
        spark, {"LINES.RRF": f"{folder}/LINES.RRF", "OTHER.RRF": f"{folder}/OTHER.RRF"},
        {"LINES": ["KEY", "LINE", "NOTE", "FLAG"]}, ["lines", "other"],
        "20240101_000000", "01012024",
    )
    return frames["LINES"]


@query("raw_runs_latest", """
SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders
WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
""")
def raw_runs_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text kept by run, then only the newest run."""
    base = scratch_path(spark, "raw")
    rows = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("value"),
        F.date_format("o_orderdate", "yyyy'0101_000000'").alias("run_id"),
    )
    rows.write.partitionBy("run_id").parquet(base)
    return files.latest_run(files.read_runs(spark, base, "value string, run_id string")).select("value")


@query("newest_release", """
WITH f AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'readme.txt'
                  ELSE 'full_' || strftime(o_orderdate, '%m%d%Y') || '.zip' END AS n,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS d FROM orders)
SELECT DISTINCT n AS file_name, strftime(d, '%Y-%m-%d') AS release_date
FROM f WHERE d = (SELECT max(d) FROM f)
""")
def newest_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.concat(F.lit("full_"), F.date_format("o_orderdate", "MMddyyyy"), F.lit(".zip"))
    names = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "readme.txt").otherwise(stamp).alias("name")
    )
    return iso_dates(files.newest_release(names, "name"))


@query("json_class_list", """
SELECT CAST(event_id AS VARCHAR) AS class_id, event_type AS class_name, '' AS class_type,
  'r1' AS meta_run_id FROM events
UNION ALL
SELECT '', '', CAST(json_extract(props, '$.k') AS VARCHAR), 'r1' FROM events
""")
def json_class_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event with two elements, each lacking some fields."""
    bodies = table(spark, sf_dir, "events").select(F.format_string(
        '{"rxclassMinConceptList": {"rxclassMinConcept": ['
        '{"classId": "%s", "className": "%s"}, {"classType": "%s"}]}}',
        text("event_id"), "event_type", F.get_json_object("props", "$.k"),
    ).alias("body"))
    parsed = bodies.select(F.from_json("body", documents.CLASS_LIST_SCHEMA).alias("d"))
    return documents.class_rows(parsed.select("d.*"), "r1")


MEMBER_RESPONSES_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS product_rxcui, o_orderstatus AS product_tty,
  CAST(o_custkey AS VARCHAR) AS "minConcept_rxcui", o_orderpriority AS "minConcept_name",
  'IN' AS "minConcept_tty", 'C' || o_orderstatus AS "rxclassMinConceptItem_classId",
  'class ' || o_orderpriority AS "rxclassMinConceptItem_className",
  'DISEASE' AS "rxclassMinConceptItem_classType", 'may_treat' AS rela, 'MEDRT' AS "relaSource",
  'r1' AS meta_run_id
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, 'X', NULL, NULL, 'A01', NULL, 'ATC1-4', NULL,
  'ATC', 'r1'
FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'
"""


@query("json_drug_classes", MEMBER_RESPONSES_SQL)
def json_drug_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses: empty ones, and relationships without a class or a concept id."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    body = F.format_string(
        '{"rxclassDrugInfoList": {"rxclassDrugInfo": ['
        '{"minConcept": {"rxcui": "%s", "name": "%s", "tty": "IN"}, "rxclassMinConceptItem": '
        '{"classId": "%s", "className": "class %s", "classType": "DISEASE"}, '
        '"rela": "may_treat", "relaSource": "MEDRT"}, '
        '{"minConcept": {%s}, "rxclassMinConceptItem": '
        '{"classId": "A01", "classType": "ATC1-4"}, "relaSource": "ATC"}]}}',
        text("o_custkey"), priority,
        F.when(status == "P", "").otherwise(F.concat(F.lit("C"), status)), priority,
        F.when(status == "F", "").otherwise('"rxcui": "X"'),
    )
    responses = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("product_rxcui"), status.alias("product_tty"),
        F.when(priority == "5-LOW", "{}").otherwise(body).alias("body"),
    )
    return documents.drug_class_rows(responses, "r1")


@query("sink_roundtrip", """
SELECT o_orderkey, o_orderstatus AS status, o_orderpriority FROM orders
""")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwritten twice, partitioned; only the second write may be found."""
    path = files.table_path(scratch_path(spark, "sink"), "orders", ["orders", "customers"])
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), "o_orderpriority"
    )
    tables.overwrite(rows.withColumn("status", F.lit("stale")), path, partition_by="status")
    tables.overwrite(rows, path, partition_by="status")
    return spark.read.schema(rows.schema).parquet(path)


@query("staging_batches", """
SELECT ingestion_batch_id, fingerprint, count(*) AS n FROM (
  SELECT CASE WHEN b = 1 THEN '2024-01-01T00:00:00' ELSE '2024-01-02T00:00:00' END AS ingestion_batch_id,
    md5(concat_ws('|', CAST(c_custkey AS VARCHAR), coalesce(c_name, ''), coalesce(c_mktsegment, ''))) AS fingerprint
  FROM customer, (VALUES (1), (2)) AS v(b)
  WHERE b = 1 OR c_acctbal > 0)
GROUP BY ALL
""")
def staging_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprinted entities per batch; a batch written again replaces itself."""
    from stratalake.functions.hashing import fingerprint

    path = scratch_path(spark, "staging")
    customers = table(spark, sf_dir, "customer")
    entities = customers.withColumn(
        "fingerprint", fingerprint(customers, ["c_custkey", "c_name", "c_mktsegment"])
    )
    tables.append_batch(entities, path, "2024-01-01T00:00:00")
    for _ in range(2):
        tables.append_batch(entities.filter("c_acctbal > 0"), path, "2024-01-02T00:00:00")
    staged = spark.read.option("basePath", path).parquet(path)
    return staged.groupBy(
        F.col("ingestion_batch_id").cast("string").alias("ingestion_batch_id"), "fingerprint"
    ).agg(F.count(F.lit(1)).alias("n"))


@query("run_summary", """
SELECT 'orders' AS dataset, 'r1' AS run_id, count(*) AS rows, count(DISTINCT o_custkey) AS customers
FROM orders
UNION ALL
SELECT 'lineitem', 'r1', count(*), NULL FROM lineitem
""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary row per data set, appended to a metrics table."""
    path = scratch_path(spark, "metrics")
    orders = table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").alias("customers")
    )
    lines = table(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("bigint").alias("customers")
    )
    for name, summary in (("orders", orders), ("lineitem", lines)):
        tables.append_run_metrics(spark, path, columns.stamp(summary, dataset=name, run_id="r1"))
    return spark.read.parquet(path).select("dataset", "run_id", "rows", "customers")
