"""Integrity and quality checks, grouped counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import aggregates, integrity, merge, quality
from stratalake.workload import query
from stratalake.workload.common import iso_dates, table


def order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history with faults: a customer's orders as validity periods.

    They overlap, leave gaps, repeat, and some open ones call themselves closed.
    """
    day = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    end = (
        F.when(status == "O", F.lit("9999-12-31").cast("date"))
        .when(F.col("o_orderpriority") == "5-LOW", day)
        .otherwise(F.date_add(day, 90))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", day.alias("active_from"), end.alias("active_to"),
        F.when((status == "O") | (F.col("o_orderpriority") == "1-URGENT"), "current")
        .otherwise("historical").alias("status"),
    )


PERIODS_SQL = """
periods AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS active_from,
  CASE WHEN o_orderstatus = 'O' THEN DATE '9999-12-31'
       WHEN o_orderpriority = '5-LOW' THEN CAST(o_orderdate AS DATE)
       ELSE CAST(o_orderdate AS DATE) + 90 END AS active_to,
  CASE WHEN o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' THEN 'current' ELSE 'historical' END AS status
  FROM orders)
"""


@query("integrity_dupes", f"""WITH {PERIODS_SQL}
SELECT o_custkey, count(*) AS current_count FROM periods WHERE active_to = DATE '9999-12-31'
GROUP BY o_custkey HAVING count(*) > 1""")
def integrity_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.duplicate_current(order_periods(spark, sf_dir), "o_custkey")


@query("integrity_status", f"""WITH {PERIODS_SQL}
SELECT o_orderkey, status FROM periods
WHERE (active_to = DATE '9999-12-31' AND status <> 'current') OR (active_to < DATE '9999-12-31' AND status <> 'historical')""")
def integrity_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.status_mismatches(order_periods(spark, sf_dir)).select("o_orderkey", "status")


@query("integrity_intervals", f"""WITH {PERIODS_SQL},
d AS (SELECT o_custkey, active_from, active_to, count(*) AS n FROM periods GROUP BY ALL),
w AS (SELECT *, max(active_to) OVER (PARTITION BY o_custkey ORDER BY active_from, active_to
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM d)
SELECT o_custkey, strftime(active_from, '%Y-%m-%d') AS active_from, strftime(active_to, '%Y-%m-%d') AS active_to,
  CASE WHEN active_from > reached AND NOT (n > 1 AND active_from < active_to) THEN 'GAP' ELSE 'OVERLAP' END AS fault
FROM w WHERE active_from > reached OR active_from < reached OR (n > 1 AND active_from < active_to)""")
def integrity_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(integrity.interval_faults(order_periods(spark, sf_dir), "o_custkey"))


@query("integrity_overlaps", f"""WITH {PERIODS_SQL}
SELECT a.o_custkey, count(*) AS overlaps FROM periods a JOIN periods b
  ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
  AND a.active_from <= b.active_to AND a.active_to >= b.active_from
GROUP BY a.o_custkey""")
def integrity_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pairs per key, counted without building the pairs."""
    return integrity.overlapping_pairs(order_periods(spark, sf_dir), "o_custkey")


@query("quality_report", """
SELECT count(*) AS total, count(*) FILTER (quality IS NULL) AS missing_quality,
  count(*) FILTER (toxic IS NULL) AS missing_toxic, count(*) FILTER (coalesce(lang, '') = '') AS missing_lang,
  count(*) FILTER (coalesce(text, '') = '') AS missing_text
FROM documents LEFT JOIN labels USING (doc_id)
""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.completeness(documents, ["quality", "toxic", "lang", "text"])


@query("coverage_pct", """
SELECT count(*) AS total, count(quality) AS enriched, 100.0 * count(quality) / count(*) AS enriched_pct
FROM documents LEFT JOIN labels USING (doc_id)
""")
def coverage_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return merge.coverage(merge.enrich(documents, labels, {"doc_id": "doc_id"}), "quality")


@query("group_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_counts(table(spark, sf_dir, "events"), ["event_type"], "n")


@query("two_column_counts", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL
""")
def two_column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_counts(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "n"
    )


@query("top_groups", """
SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 20
""")
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_groups(table(spark, sf_dir, "lineitem"), ["l_suppkey"], 20, "n")


@query("counts_and_distinct", """
SELECT event_type, count(*) AS record_count, count(DISTINCT user_id) AS users FROM events GROUP BY 1
""")
def counts_and_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.counts_and_distinct(
        table(spark, sf_dir, "events"), ["event_type"], "user_id", "record_count", "users"
    )


@query("ratio_per_group", """
SELECT l_shipmonth, count(*) AS line_count, count(DISTINCT l_partkey) AS parts,
  round(CAST(count(*) AS DOUBLE) / count(DISTINCT l_partkey), 1) AS per_part
FROM (SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS l_shipmonth FROM lineitem) GROUP BY 1
""")
def ratio_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth")
    )
    return aggregates.rows_per_entity(
        lines, ["l_shipmonth"], "l_partkey", "line_count", "parts", "per_part"
    )


@query("distinct_per_group", """
SELECT l_returnflag, l_linestatus, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2
""")
def distinct_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distinct_per_group(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_suppkey", "suppliers"
    )


@query("repeated_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()
