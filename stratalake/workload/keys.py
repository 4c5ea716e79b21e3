"""Keys that are bad, held, hot or of different types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.hashing import fingerprint
from stratalake.operators import skew
from stratalake.plans import daily
from stratalake.session import scratch_path, staged
from stratalake.sinks.versioned import VersionedTable
from stratalake.workload import query
from stratalake.workload.common import iso_dates, table, text

DAY1, DAY2 = "2050-01-01", "2050-01-02"
# On the second day customers come by their orders: some key is missing, many repeat.
_SECOND_SQL = """
second AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, o_orderpriority AS v FROM orders),
times AS (SELECT k, count(*) AS n, min(v) AS v FROM second WHERE k IS NOT NULL GROUP BY k)
"""


def two_days(spark: SparkSession, sf_dir: str) -> tuple[VersionedTable, str]:
    """A table after customers and then their orders were loaded, and where its rejects are."""
    path = scratch_path(spark, "held")
    gold = VersionedTable(spark, f"{path}/gold", "k", ["v"])
    first = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    second = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"), F.col("o_orderpriority").alias("v"))
    daily.apply_snapshot(gold, first, f"{path}/rejects", DAY1, "run1")
    daily.apply_snapshot(gold, second, f"{path}/rejects", DAY2, "run2")
    return gold, f"{path}/rejects/reject_run_id=run2"


@query("flow_rejects", f"""WITH {_SECOND_SQL}
SELECT s.k, s.v, CASE WHEN s.k IS NULL THEN 'missing key' ELSE 'repeated key' END AS reject_reason
FROM second s LEFT JOIN times t ON t.k = s.k WHERE s.k IS NULL OR t.n > 1""")
def flow_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a run could not use, with the reason."""
    return spark.read.parquet(two_days(spark, sf_dir)[1]).select("k", "v", "reject_reason")


@query("scd2_held_keys", f"""WITH {_SECOND_SQL},
met AS (SELECT coalesce(c_custkey, k) AS k, c_mktsegment AS old, v AS new, coalesce(n, 0) AS n FROM customer FULL JOIN times ON c_custkey = k)
SELECT k, old AS v, 'current' AS status, '{DAY1}' AS active_from, '9999-12-31' AS active_to FROM met WHERE old IS NOT NULL AND n > 1
UNION ALL SELECT k, old, 'historical', '{DAY1}', '{DAY2}' FROM met WHERE old IS NOT NULL AND n <= 1
UNION ALL SELECT k, new, 'current', '{DAY2}', '9999-12-31' FROM met WHERE n = 1""")
def scd2_held_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that arrived in unusable rows keeps its open version; one that did not arrive loses it."""
    return iso_dates(two_days(spark, sf_dir)[0].read().select("k", "v", "status", "active_from", "active_to"))


@query("full_outer_hot_key", """
WITH l AS (SELECT CASE WHEN l_returnflag = 'N' THEN 'hot' ELSE CAST(l_partkey AS VARCHAR) END AS k, l_orderkey, l_linenumber FROM lineitem),
r AS (SELECT CASE WHEN s_suppkey <= 3 THEN 'hot' ELSE CAST(s_suppkey AS VARCHAR) END AS k, s_name FROM supplier)
SELECT coalesce(l.k, r.k) AS k, l_orderkey, l_linenumber, s_name FROM l FULL JOIN r ON l.k = r.k""")
def full_outer_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of about half the rows of one side and several of the other, cut into pieces of 500 rows."""
    left = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "N", "hot").otherwise(text("l_partkey")).alias("k"), "l_orderkey", "l_linenumber")
    right = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_suppkey") <= 3, "hot").otherwise(text("s_suppkey")).alias("k"), "s_name")
    return skew.skew_join(left, right, ["k"], "full_outer", rows_per_task=500)


@query("full_outer_mixed_types", """
SELECT coalesce(CAST(o_custkey AS DECIMAL(20, 0)), CAST(l_partkey AS DECIMAL(20, 0))) AS k, n, m FROM
  (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) FULL JOIN
  (SELECT l_partkey, count(*) AS m FROM lineitem GROUP BY 1) ON o_custkey = l_partkey""")
def full_outer_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers meet decimals; keys come out in the type that holds both."""
    left = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    right = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").cast("decimal(20,0)").alias("k")).agg(F.count(F.lit(1)).alias("m"))
    joined = skew.skew_join(staged(left, "left"), staged(right, "right"), ["k"], "full_outer", rows_per_task=100)
    return joined.withColumn("k", F.col("k").cast("decimal(20,0)"))


@query("fingerprint_doubles", """
SELECT l_orderkey, l_linenumber,
  md5(coalesce(CASE WHEN CAST(CAST(x AS DECIMAL(38,6)) AS DOUBLE) = x THEN CAST(CAST(x AS DECIMAL(38,6)) AS VARCHAR)
    ELSE CAST(x AS VARCHAR) END, '') || '|' || l_returnflag) AS fingerprint
FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN l_quantity / 8 ELSE l_extendedprice / 7 END AS x FROM lineitem)""")
def fingerprint_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of few digits by their decimals, others by all of their digits."""
    x = F.when(F.col("l_linestatus") == "O", F.col("l_quantity") / 8).otherwise(F.col("l_extendedprice") / 7)
    lines = table(spark, sf_dir, "lineitem").withColumn("x", x)
    return lines.select("l_orderkey", "l_linenumber", fingerprint(lines, ["x", "l_returnflag"]).alias("fingerprint"))
