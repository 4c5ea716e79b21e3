"""Records that cannot be read, samples of them, and whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.session import scratch_path, staged
from stratalake.sinks import tables
from stratalake.sources import documents, files
from stratalake.workload import query
from stratalake.workload.common import table, text


@query("malformed_lines", """
SELECT 'row' AS outcome, CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS detail FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'malformed record', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderpriority = '1-URGENT'
  THEN o_orderkey || ',P' ELSE o_orderkey || ',P,' || o_orderpriority || ',more' END FROM orders WHERE o_orderstatus = 'P'
""")
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few or too many fields come out as rejects, all others as rows."""
    path = scratch_path(spark, "lines")
    key, status, priority = text("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    rest = F.when(status != "P", F.concat(F.lit(","), priority)).when(
        priority == "1-URGENT", "").otherwise(F.concat(F.lit(","), priority, F.lit(",more")))
    lines = table(spark, sf_dir, "orders").select(
        F.concat(key, F.lit(","), status, rest).alias("value"), F.pmod("o_orderkey", F.lit(4)).cast("int").alias("file"))
    header = spark.range(4).select(F.lit("key,status,priority").alias("value"), F.col("id").cast("int").alias("file"))
    # Four files, each with a header of its own.
    both = header.withColumn("at", F.lit(0)).unionByName(lines.withColumn("at", F.lit(1)))
    both.repartition("file").sortWithinPartitions("file", "at").drop("at").write.partitionBy("file").text(path)
    good, bad = files.split_malformed(staged(files.read_delimited_checked(spark, path), "checked"))
    return good.select(F.lit("row").alias("outcome"), F.col("key").alias("k"), F.col("priority").alias("detail")).unionByName(
        bad.select(F.col("reason").alias("outcome"), F.split("record", ",")[0].alias("k"), F.col("record").alias("detail")))


@query("malformed_documents", """
SELECT CAST(o_orderkey AS VARCHAR) AS product_rxcui, CASE o_orderpriority WHEN '1-URGENT' THEN 'malformed body'
  WHEN '2-HIGH' THEN 'no body' ELSE 'readable' END AS outcome,
  CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') THEN 'C' || o_orderstatus END AS class_id FROM orders
""")
def malformed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer is read or rejected; one that lists no classes is read."""
    priority = F.col("o_orderpriority")
    body = F.format_string(
        '{"rxclassDrugInfoList": {"rxclassDrugInfo": [{"minConcept": {"rxcui": "1"}, "rxclassMinConceptItem": {"classId": "C%s"}}]}}',
        "o_orderstatus")
    responses = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("product_rxcui"), F.col("o_orderstatus").alias("product_tty"),
        F.when(priority == "1-URGENT", F.substring(body, 1, 40)).when(priority == "2-HIGH", " ")
        .when(priority == "5-LOW", "{}").otherwise(body).alias("body"))
    readable, rejected = documents.split_responses(responses)
    classes = documents.drug_class_rows(readable, "r1").select(
        "product_rxcui", F.col("rxclassMinConceptItem_classId").alias("class_id"))
    return readable.select("product_rxcui", F.lit("readable").alias("outcome")).join(
        classes, "product_rxcui", "left").unionByName(
        rejected.select("product_rxcui", F.col("reason").alias("outcome")), allowMissingColumns=True)


@query("reject_sample", """
WITH r AS (SELECT o_orderstatus AS reason, CAST(o_orderkey AS BIGINT) AS o_orderkey,
    md5('{"o_orderkey":' || o_orderkey || '}') AS drawn FROM orders)
SELECT reason, o_orderkey FROM r QUALIFY row_number() OVER (PARTITION BY reason ORDER BY drawn) <= 20""")
def reject_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rejects of each reason, the same however the rows lie."""
    rejects = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("reason"), "o_orderkey")
    return quality.sample_per_reason(rejects, "reason", 20, ["o_orderkey"])


@query("raw_documents", """
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS length, sha256(text) AS digest, true AS sound
FROM documents WHERE text IS NOT NULL""")
def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of many lines are kept as they are, and an earlier attempt of the run is replaced."""
    path = scratch_path(spark, "documents")
    content = F.col("text").cast("binary")
    given = table(spark, sf_dir, "documents").filter("text is not null").select(
        text("doc_id").alias("path"), F.octet_length("text").cast("long").alias("length"), content.alias("content"))
    for part in (given.limit(3), given):
        tables.keep_documents(part, path, "20500101_000000")
    kept = spark.read.parquet(path)
    sound = F.sha2("content", 256) == F.col("digest")
    return kept.select(F.col("path").cast("bigint").alias("doc_id"), "length", "digest", sound.alias("sound"))


@query("completeness_gate", """
SELECT count(*) AS total, count(*) FILTER (l_returnflag = 'R') AS missing_price,
  count(*) FILTER (l_linestatus = 'O') AS missing_status, 0 AS missing_l_orderkey FROM lineitem""")
def completeness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values by column; the gate passes as only the key is critical."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linestatus") == "O", "").otherwise("done").alias("status"))
    return quality.gate_completeness(lines, ["price", "status", "l_orderkey"], ["l_orderkey"])
