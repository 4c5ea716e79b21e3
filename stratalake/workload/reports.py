"""Documented questions on product classes derived from shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.hashing import fingerprint
from stratalake.operators import aggregates, columns
from stratalake.plans import concepts, reports
from stratalake.workload import query
from stratalake.workload.common import table, text


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One class membership per shipment, under the source's long names."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("product_rxcui"),
        F.when(F.col("l_partkey") > F.col("l_suppkey") * 10, "SCD").otherwise("SBD").alias("product_tty"),
        text("l_suppkey").alias("minConcept_rxcui"),
        F.concat(F.lit("ingredient "), text("l_suppkey")).alias("minConcept_name"),
        F.lit("IN").alias("minConcept_tty"),
        F.concat(flag, text("l_linenumber")).alias("rxclassMinConceptItem_classId"),
        F.concat(F.lit("Class "), flag, F.lit(" "), text("l_linenumber")).alias("rxclassMinConceptItem_className"),
        F.when(flag == "A", "DISEASE").when(flag == "N", "EPC").otherwise("ATC1-4").alias("rxclassMinConceptItem_classType"),
        F.when(status == "O", "may_treat").otherwise("CI_with").alias("rela"),
        F.when(flag == "A", "MEDRT").when(flag == "N", "DAILYMED").otherwise("ATC").alias("relaSource"),
        F.lit("r1").alias("meta_run_id"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts.class_snapshot(raw_members(spark, sf_dir), "rxclass_drug_members", "2050-01-01")


MEMBERS_SQL = """
members AS (SELECT CAST(l_partkey AS VARCHAR) AS rxcui, CASE WHEN l_partkey > l_suppkey * 10 THEN 'SCD' ELSE 'SBD' END AS tty,
  CAST(l_suppkey AS VARCHAR) AS minconcept_rxcui, 'ingredient ' || l_suppkey AS minconcept_name, 'IN' AS minconcept_tty,
  l_returnflag || l_linenumber AS class_id, 'Class ' || l_returnflag || ' ' || l_linenumber AS class_name,
  CASE l_returnflag WHEN 'A' THEN 'DISEASE' WHEN 'N' THEN 'EPC' ELSE 'ATC1-4' END AS class_type,
  CASE l_linestatus WHEN 'O' THEN 'may_treat' ELSE 'CI_with' END AS rela,
  CASE l_returnflag WHEN 'A' THEN 'MEDRT' WHEN 'N' THEN 'DAILYMED' ELSE 'ATC' END AS relasource,
  'r1' AS source_run_id, 'silver.rxclass_drug_members' AS source_file FROM lineitem)
"""


@query("class_snapshot", f"WITH {MEMBERS_SQL} SELECT * FROM members")
def class_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir)


@query("class_profile", f"""WITH {MEMBERS_SQL}
SELECT rxcui, tty, minconcept_name AS ingredient, class_name AS classification, class_type, rela, relasource
FROM members WHERE rxcui = '7'""")
def class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.class_profile(members(spark, sf_dir), "7")


@query("products_for_condition", f"""WITH {MEMBERS_SQL}
SELECT DISTINCT rxcui, tty, minconcept_name AS ingredient, class_name AS condition, rela, relasource FROM members
WHERE lower(class_name) LIKE '%a 3%' AND rela IN ('may_treat', 'may_prevent') AND class_type = 'DISEASE'""")
def products_for_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.products_for_condition(
        members(spark, sf_dir), "A 3", ["may_treat", "may_prevent"], "DISEASE"
    )


@query("label_classes", f"""WITH {MEMBERS_SQL}
SELECT DISTINCT rxcui, minconcept_name AS ingredient, class_name AS classification, class_type, rela
FROM members WHERE relasource = 'DAILYMED'""")
def label_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_classes(members(spark, sf_dir), "DAILYMED")


@query("contraindications", f"""WITH {MEMBERS_SQL}
SELECT DISTINCT rxcui, class_name AS contraindicated_condition FROM members
WHERE rela = 'CI_with' AND class_type = 'DISEASE'""")
def contraindications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.contraindications(members(spark, sf_dir), "CI_with", "DISEASE")


@query("products_with_atc", f"""WITH {MEMBERS_SQL}
SELECT p.rxcui, p.p_name, m.class_id AS code, m.class_name AS code_name
FROM (SELECT CAST(p_partkey AS VARCHAR) AS rxcui, p_name FROM part) p
LEFT JOIN members m ON p.rxcui = m.rxcui AND m.relasource = 'ATC'""")
def products_with_atc(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = table(spark, sf_dir, "part").select(text("p_partkey").alias("rxcui"), "p_name")
    return reports.with_source_code(products, members(spark, sf_dir), "ATC")


@query("classes_per_source", f"""WITH {MEMBERS_SQL}
SELECT relasource, count(DISTINCT class_id) AS num_classes FROM members GROUP BY 1""")
def classes_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.classes_per_source(members(spark, sf_dir))


@query("coverage_by_type", f"""WITH {MEMBERS_SQL}
SELECT tty, count(*) AS num_classifications, count(DISTINCT rxcui) AS num_products,
  round(CAST(count(*) AS DOUBLE) / count(DISTINCT rxcui), 1) AS avg_per_product FROM members GROUP BY 1""")
def coverage_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_by_type(members(spark, sf_dir))


@query("source_relation_counts", f"""WITH {MEMBERS_SQL}
SELECT relasource, rela, count(*) AS count FROM members GROUP BY 1, 2""")
def source_relation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.source_relation_counts(members(spark, sf_dir))


@query("classes_of_product", f"""WITH {MEMBERS_SQL}
SELECT rxcui, count(DISTINCT class_id) AS classes, count(DISTINCT relasource) AS sources FROM members GROUP BY 1""")
def classes_of_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.classes_of(members(spark, sf_dir))


@query("products_of_class", f"""WITH {MEMBERS_SQL}
SELECT class_id, class_type, count(DISTINCT rxcui) AS products FROM members GROUP BY 1, 2""")
def products_of_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.members_of(members(spark, sf_dir))


@query("lookup_classes", f"""WITH {MEMBERS_SQL}
SELECT DISTINCT rxcui, class_id, class_name, class_type, rela, relasource FROM members
WHERE rxcui IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 25)""")
def lookup_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "part").filter("p_size > 25").select(text("p_partkey").alias("rxcui"))
    return reports.lookup_classes(members(spark, sf_dir), wanted)


@query("lookup_products", f"""WITH {MEMBERS_SQL}
SELECT DISTINCT class_id, class_name, rxcui, tty, rela, relasource FROM members
WHERE class_id IN (SELECT l_returnflag || l_linenumber FROM lineitem WHERE l_discount > 0.05)""")
def lookup_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "lineitem").filter("l_discount > 0.05").select(
        F.concat("l_returnflag", text("l_linenumber")).alias("class_id")).distinct()
    return reports.lookup_products(members(spark, sf_dir), wanted)


@query("top_class_types", f"""WITH {MEMBERS_SQL}
SELECT class_type, count(*) AS count FROM members GROUP BY 1 ORDER BY count DESC, class_type LIMIT 20""")
def top_class_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_groups(members(spark, sf_dir), ["class_type"], 20)


@query("controlled_order", """
SELECT p_partkey, p_name, CASE WHEN p_size <= 10 THEN 'CII' ELSE 'CIV' END AS dea_schedule
FROM part WHERE p_size <= 20 ORDER BY dea_schedule, p_name, p_partkey LIMIT 100
""")
def controlled_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sorted sample: the first rows in schedule and name order."""
    schedule = F.when(F.col("p_size") <= 10, "CII").when(F.col("p_size") <= 20, "CIV")
    return (
        table(spark, sf_dir, "part").select("p_partkey", "p_name", schedule.alias("dea_schedule"))
        .filter(F.col("dea_schedule").isNotNull())
        .orderBy("dea_schedule", "p_name", "p_partkey").limit(100)
    )


@query("content_fingerprints", """
SELECT l_orderkey, l_linenumber, md5(concat_ws('|', CAST(CAST(l_extendedprice AS DECIMAL(38,6)) AS VARCHAR),
  l_returnflag, strftime(l_shipdate, '%Y-%m-%d'), CAST(l_quantity > 10 AS VARCHAR))) AS content_hash FROM lineitem
""")
def content_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag",
        F.col("l_shipdate").cast("date").alias("shipped"), (F.col("l_quantity") > 10).alias("big"),
    )
    digest = fingerprint(lines, ["l_extendedprice", "l_returnflag", "shipped", "big"])
    return columns.require_key(lines, "l_orderkey").select(
        "l_orderkey", "l_linenumber", digest.alias("content_hash")
    )
