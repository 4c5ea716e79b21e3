"""Row filters, renames, scalar functions and plain joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import text as tx
from stratalake.functions.hashing import fingerprint
from stratalake.operators import aggregates, columns, merge, quality
from stratalake.workload import query
from stratalake.workload.common import iso_dates, table, text


@query("active_rows", """
SELECT o_orderkey FROM orders
WHERE o_orderstatus IN ('P', 'F') OR o_orderpriority = '1-URGENT'
""")
def active_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppression flag NULL, '', 'N' and 'O'."""
    flag = (
        F.when(F.col("o_orderstatus") == "F", "")
        .when(F.col("o_orderstatus") == "O",
              F.when(F.col("o_orderpriority") == "1-URGENT", "N").otherwise("O"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", flag.alias("Suppress"))
    return columns.active_only(columns.active_only(rows), "no_such_flag").select("o_orderkey")


@query("exclude_flag", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'N' END AS flag
FROM orders WHERE o_orderstatus <> 'F'
""")
def exclude_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "F", "E").when(F.col("o_orderstatus") == "O", "N")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", flag.alias("flag"))
    return columns.exclude_value(rows, "flag", "E")


@query("column_rename", """
SELECT c_custkey AS custkey, c_name AS customer_name, c_mktsegment AS mktsegment, 'r1' AS source_run_id,
  '2024-01-31' AS source_release_date, 'silver.customer' AS source_file
FROM customer WHERE c_mktsegment IS NOT NULL
""")
def column_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.stamp(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        meta_run_id="r1",
    )
    short = columns.rename_existing(
        columns.strip_prefix(rows, "c_"), {"NAME": "customer_name", "absent": "x"}
    )
    return columns.gold_lineage(
        columns.require_key(short, "mktsegment"), "silver.customer", "2024-01-31", release_column=True
    )


@query("text_predicates", """
SELECT p_partkey, p_name FROM part
WHERE lower(p_name) LIKE '%ring%' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')
  AND p_size BETWEEN 5 AND 40 AND p_type LIKE 'S%'
""")
def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(
        columns.contains_text("p_name", "RING")
        & F.col("p_brand").isin([f"Brand#{i}" for i in range(1, 6)])
        & F.col("p_size").between(5, 40) & F.col("p_type").startswith("S")
    ).select("p_partkey", "p_name")


LINE_CODE_SQL = """
CASE WHEN l_returnflag = 'N' THEN NULL
     WHEN l_linestatus = 'F' THEN l_orderkey || '-' || l_partkey
     ELSE l_orderkey || '-' || l_partkey || '-' || l_linenumber END
"""


def line_code():
    short = F.concat_ws("-", text("l_orderkey"), text("l_partkey"))
    return F.when(
        F.col("l_returnflag") != "N",
        F.when(F.col("l_linestatus") == "F", short)
        .otherwise(F.concat_ws("-", short, text("l_linenumber"))),
    )


@query("code_normalise", f"""
WITH c AS (SELECT l_orderkey, l_linenumber, {LINE_CODE_SQL} AS code FROM lineitem),
n AS (SELECT *, lpad(split_part(code, '-', 1), 5, '0') || lpad(split_part(code, '-', 2), 4, '0')
   || lpad(nullif(split_part(code, '-', 3), ''), 2, '0') AS code_11 FROM c)
SELECT l_orderkey, l_linenumber, code, code_11, substr(code_11, 1, 5) AS code_5,
  nullif(split_part(code, '-', 3), '') AS third FROM n
""")
def code_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", line_code().alias("code")
    )
    code = F.col("code")
    return rows.withColumn("code_11", tx.package_code(code)).withColumns(
        {"code_5": tx.labeler_code(F.col("code_11")), "third": tx.part_of(code, "-", 2)}
    )


RAW_CODES_SQL = """
codes AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN lpad(CAST(l_partkey AS VARCHAR), 11, '0')
   WHEN l_returnflag = 'N' THEN lpad(CAST(l_partkey AS VARCHAR), 10, 'X') || '1'
   WHEN l_linestatus = 'O' THEN CAST(l_partkey AS VARCHAR) END AS ndc_11 FROM lineitem)
"""


def raw_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = text("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "A", F.lpad(part, 11, "0"))
        .when(F.col("l_returnflag") == "N", F.concat(F.lpad(part, 10, "X"), F.lit("1")))
        .when(F.col("l_linestatus") == "O", part).alias("ndc_11"),
    )


@query("code_validity", f"""
WITH {RAW_CODES_SQL}
SELECT l_orderkey, ndc_11, CAST(length(ndc_11) AS INTEGER) AS ndc_length,
  regexp_matches(ndc_11, '^[0-9]+$') AS ndc_is_numeric,
  length(ndc_11) = 11 AND regexp_matches(ndc_11, '^[0-9]+$') AS ndc_is_valid FROM codes
""")
def code_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.code_validity(raw_codes(spark, sf_dir), "ndc_11")


@query("validity_report", f"""
WITH {RAW_CODES_SQL},
v AS (SELECT coalesce(length(ndc_11) = 11 AND regexp_matches(ndc_11, '^[0-9]+$'), false) AS ok FROM codes)
SELECT count(*) AS total, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid,
  round(100.0 * count(*) FILTER (ok) / count(*), 1) AS valid_pct FROM v
""")
def validity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.code_validity(raw_codes(spark, sf_dir), "ndc_11")
    return quality.validity_report(checked, F.col("ndc_is_valid"))


@query("valid_and_rejected", f"""
WITH {RAW_CODES_SQL}
SELECT ok, count(*) AS n FROM (
  SELECT CASE WHEN length(ndc_11) = 11 AND regexp_matches(ndc_11, '^[0-9]+$') THEN 'valid' ELSE 'rejected' END AS ok
  FROM codes) GROUP BY ok
""")
def valid_and_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.code_validity(raw_codes(spark, sf_dir), "ndc_11")
    valid, rejected = columns.split_valid(checked, F.col("ndc_is_valid"))
    both = columns.stamp(valid, ok="valid").unionByName(columns.stamp(rejected, ok="rejected"))
    return aggregates.group_counts(both, ["ok"], "n")


@query("scalar_pack", """
SELECT p_partkey, lower(p_name) AS low, upper(p_name) AS up,
  CAST(length(trim('  ' || p_name || ' ')) AS INTEGER) AS trimmed_length,
  nullif(split_part(p_brand, '#', 2), '') AS brand_number,
  CASE WHEN p_size <= 20 THEN p_size || ' mg/ml' WHEN p_size <= 35 THEN p_size || ' mg'
       ELSE p_size || ' mg (expressed as other)' END AS strength,
  concat_ws(' ', p_brand, CASE WHEN p_size > 25 THEN lower(p_type) END) AS full_name,
  md5(concat_ws('|', p_name, p_brand, CAST(p_size AS VARCHAR),
      CAST(CAST(p_retailprice AS DECIMAL(38,6)) AS VARCHAR))) AS fingerprint
FROM part
""")
def scalar_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    size = text("p_size")
    strength = (
        F.when(F.col("p_size") <= 20, F.concat(size, F.lit(" MG/ML")))
        .when(F.col("p_size") <= 35, F.concat(size, F.lit(" MG (EXPRESSED AS "), F.upper("p_name"), F.lit(")")))
        .otherwise(F.concat(size, F.lit(" MG (EXPRESSED AS OTHER)")))
    )
    return parts.select(
        "p_partkey", F.lower("p_name").alias("low"), F.upper("p_name").alias("up"),
        F.length(F.trim(F.concat(F.lit("  "), "p_name", F.lit(" ")))).alias("trimmed_length"),
        tx.part_of(F.col("p_brand"), "#", 1).alias("brand_number"),
        tx.strip_expressed_as(strength, F.col("p_name")).alias("strength"),
        F.concat_ws(" ", "p_brand", F.when(F.col("p_size") > 25, F.lower("p_type"))).alias("full_name"),
        fingerprint(parts, ["p_name", "p_brand", "p_size", "p_retailprice"]).alias("fingerprint"),
    )


@query("joined_sets", """
SELECT l_partkey,
  coalesce(string_agg(DISTINCT CASE WHEN l_returnflag <> 'N' THEN lower(l_returnflag || l_linestatus) END, ' / '
    ORDER BY CASE WHEN l_returnflag <> 'N' THEN lower(l_returnflag || l_linestatus) END), '') AS flags,
  'Pack (' || string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ' / ' ORDER BY CAST(l_linenumber AS VARCHAR)) || ')' AS lines,
  count(CASE WHEN l_returnflag = 'N' THEN 1 END) > 0 AS has_n
FROM lineitem GROUP BY l_partkey
""")
def joined_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.lower(F.concat("l_returnflag", "l_linestatus"))
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        aggregates.set_text(F.when(F.col("l_returnflag") != "N", code), " / ").alias("flags"),
        aggregates.wrapped_set_text(text("l_linenumber")).alias("lines"),
        aggregates.has_any(F.when(F.col("l_returnflag") == "N", 1)).alias("has_n"),
    )


@query("any_value_per_key", """
SELECT o_custkey, p AS picked, k AS picked_key FROM (
  SELECT o_custkey, p, o_orderkey AS k,
    row_number() OVER (PARTITION BY o_custkey ORDER BY p NULLS LAST, o_orderkey) AS rn
  FROM (SELECT *, nullif(o_orderpriority, '1-URGENT') AS p FROM orders)) WHERE rn = 1
""")
def any_value_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The picked columns come from one row, never from a row without a value if another exists."""
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("picked"),
        F.col("o_orderkey").alias("picked_key"),
    )
    return aggregates.any_value(rows, ["o_custkey"], "picked", "picked_key")


@query("wide_assembly", """
SELECT c_custkey, c_name, n_orders, last_order, spent, priorities, CAST(coalesce(big, false) AS BOOLEAN) AS big
FROM customer
LEFT JOIN (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1) a ON c_custkey = a.k
LEFT JOIN (SELECT o_custkey AS k, strftime(max(o_orderdate), '%Y-%m-%d') AS last_order FROM orders GROUP BY 1) b ON c_custkey = b.k
LEFT JOIN (SELECT o_custkey AS k, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS spent FROM orders GROUP BY 1) c ON c_custkey = c.k
LEFT JOIN (SELECT o_custkey AS k, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1) d ON c_custkey = d.k
LEFT JOIN (SELECT o_custkey AS k, max(o_totalprice) > 400000 AS big FROM orders GROUP BY 1) e ON c_custkey = e.k
""")
def wide_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five attributes that share a key come from one aggregation, not five."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    attributes = orders.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.max("o_orderdate").cast("date").alias("last_order"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias("spent"),
        aggregates.set_text(F.col("o_orderpriority"), ", ").alias("priorities"),
        (F.max("o_totalprice") > 400000).alias("big"),
    )
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    wide = merge.assemble(base, "c_custkey", [attributes])
    return iso_dates(wide.withColumn("big", F.coalesce("big", F.lit(False))))


@query("left_enrich", """
SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_type
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_type = 'PROMO'
""")
def left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return merge.enrich(lines, parts, {"l_partkey": "p_partkey"}, F.col("p_type") == "PROMO")


@query("fallback_columns", """
WITH a AS (SELECT l_partkey, string_agg(DISTINCT CASE WHEN l_returnflag = 'A' AND l_quantity > 40 THEN l_linestatus END, ', '
      ORDER BY CASE WHEN l_returnflag = 'A' AND l_quantity > 40 THEN l_linestatus END) AS s FROM lineitem GROUP BY 1),
b AS (SELECT l_partkey, string_agg(DISTINCT lower(l_linestatus), ', ' ORDER BY lower(l_linestatus)) AS s FROM lineitem GROUP BY 1)
SELECT a.l_partkey, coalesce(nullif(a.s, ''), b.s) AS status FROM a LEFT JOIN b USING (l_partkey)
""")
def fallback_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    narrow = (F.col("l_returnflag") == "A") & (F.col("l_quantity") > 40)
    filtered = lines.groupBy("l_partkey").agg(
        aggregates.set_text(F.when(narrow, F.col("l_linestatus")), ", ").alias("status")
    )
    everything = lines.groupBy("l_partkey").agg(
        aggregates.set_text(F.lower("l_linestatus"), ", ").alias("status")
    )
    return merge.filtered_or_all(filtered, everything, "l_partkey", "status")


@query("full_outer_merge", """
WITH l AS (SELECT CASE o_orderstatus WHEN 'F' THEN o_custkey ELSE o_custkey + 1000000000 END AS k,
             max(o_orderpriority) AS name, max(o_orderdate) AS since, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name END AS name,
        CASE WHEN c_acctbal > 5000 THEN TIMESTAMP '2020-01-01' END AS since FROM customer)
SELECT coalesce(l.k, r.k) AS k, coalesce(nullif(r.name, ''), l.name) AS name,
  strftime(coalesce(r.since, l.since), '%Y-%m-%d') AS since, l.n AS n, r.k IS NOT NULL AS in_right
FROM l FULL JOIN r ON l.k = r.k
""")
def full_outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordering, buyer = F.col("o_custkey"), F.col("c_custkey")
    # Customers of open orders are known on the left only, those without credit on the right only.
    left = table(spark, sf_dir, "orders").groupBy(
        F.when(F.col("o_orderstatus") == "F", ordering).otherwise(ordering + 1_000_000_000).alias("k")
    ).agg(
        F.max("o_orderpriority").alias("name"),
        F.max("o_orderdate").cast("date").alias("since"), F.count(F.lit(1)).alias("n"),
    )
    segment = F.col("c_mktsegment")
    right = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") > 0, buyer).otherwise(-buyer).alias("k"),
        F.when(segment == "BUILDING", "").when(segment != "MACHINERY", F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 5000, F.lit("2020-01-01").cast("date")).alias("since"),
    )
    return iso_dates(merge.full_outer_merge(
        left, right, "k", text=["name"], dates=["since"], left_only=["n"], flag="in_right"
    ))


@query("union_frames", """
SELECT DISTINCT k, kind, size FROM (
  SELECT p_partkey AS k, 'part' AS kind, p_size AS size FROM part
  UNION ALL SELECT s_suppkey, 'supplier', NULL FROM supplier
  UNION ALL SELECT l_partkey, 'part', p_size FROM lineitem JOIN part ON l_partkey = p_partkey)
""")
def union_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    return merge.union_all([
        columns.stamp(parts, kind="part"), columns.stamp(suppliers, kind="supplier"),
        columns.stamp(lines.join(parts, "k"), kind="part"),
    ]).distinct().select("k", "kind", "size")
