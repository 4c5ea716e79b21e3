"""The code flow on stand-ins: parts as products, shipped pairs as packages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.versioning import is_open
from stratalake.plans import daily, fda
from stratalake.plans import datasets as ds
from stratalake.session import scratch_path, staged
from stratalake.sources import files
from stratalake.workload import query
from stratalake.workload.common import iso_dates, table, text

RUN_DATE, RUN_ID = "2050-01-01", "run1"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = text("p_partkey")
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.concat(part, F.lit("_spl"), part).alias("product_id"),
        F.col("p_type").alias("product_type_name"),
        F.col("p_name").alias("proprietary_name"),
        F.lower("p_type").alias("dosage_form_name"),
        F.col("p_brand").alias("marketing_category_name"),
        F.concat(F.lit("NDA"), F.lpad(part, 6, "0")).alias("application_number"),
        F.when(size <= 10, "CII").when(size <= 20, "CIV").alias("dea_schedule"),
        text("p_size").alias("active_numerator_strength"),
        F.lit("mg").alias("active_ingredient_unit"),
        F.when(F.col("p_type") == "PROMO", "E").when(F.col("p_type") != "STANDARD", "N")
        .alias("ndc_exclude_flag"),
    )


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.min("l_shipdate").cast("date").alias("start_marketing_date"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).cast("date").alias("end_marketing_date"),
        F.count(F.lit(1)).alias("n"),
    )
    part = text("l_partkey")
    return pairs.select(
        F.concat(part, F.lit("_spl"), part).alias("product_id"),
        F.concat_ws("-", part, text("l_suppkey"), F.lit("1")).alias("ndc_package_code"),
        F.concat(text("n"), F.lit(" shipments")).alias("package_description"),
        "start_marketing_date", "end_marketing_date",
        F.lit("bronze1").alias("meta_run_id"),
    )


def nsde(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").groupBy(
        "l_partkey", "l_suppkey", "l_returnflag"
    ).agg(
        F.max("l_linestatus").alias("status"), F.max("l_shipdate").cast("date").alias("shipped"),
        F.max("l_quantity").alias("quantity"),
    )
    part, big = text("l_partkey"), F.col("quantity") > 25
    return shipped.select(
        F.concat(
            F.lpad(part, 5, "0"), F.lpad(text("l_suppkey"), 4, "0"),
            F.when(F.col("l_returnflag") == "R", "01").when(F.col("l_returnflag") == "A", "02").otherwise("03"),
        ).alias("ndc_11"),
        F.when(F.col("status") == "O", "").otherwise(F.concat(F.lit("N-"), part)).alias("proprietary_name"),
        F.when(big, "KIT").alias("dosage_form"),
        F.lit("NDA").alias("marketing_category"),
        F.when(big, F.concat(F.lit("APP"), part)).otherwise("").alias("application_number_or_citation"),
        F.lit("").alias("product_type"),
        F.when(big, F.col("shipped")).alias("marketing_start_date"),
        F.when(~big, F.col("shipped")).alias("marketing_end_date"),
        F.when(big, "EA").alias("billing_unit"),
    )


LISTED_SQL = """
products AS (SELECT CAST(p_partkey AS VARCHAR) AS part, p_type AS product_type, p_name AS proprietary_name,
    lower(p_type) AS dosage_form, p_brand AS marketing_category, 'NDA' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS application_number,
    CASE WHEN p_size <= 10 THEN 'CII' WHEN p_size <= 20 THEN 'CIV' END AS dea_schedule,
    CAST(p_size AS VARCHAR) AS active_numerator_strength, 'mg' AS active_ingredient_unit
  FROM part WHERE p_type <> 'PROMO'),
packages AS (SELECT CAST(l_partkey AS VARCHAR) AS part,
    lpad(CAST(l_partkey AS VARCHAR), 5, '0') || lpad(CAST(l_suppkey AS VARCHAR), 4, '0') || '01' AS ndc_11,
    count(*) || ' shipments' AS package_description, strftime(min(l_shipdate), '%Y-%m-%d') AS marketing_start_date,
    strftime(max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END), '%Y-%m-%d') AS marketing_end_date
  FROM lineitem GROUP BY l_partkey, l_suppkey),
listed AS (SELECT ndc_11, marketing_category, product_type, proprietary_name, dosage_form, application_number,
    dea_schedule, active_numerator_strength, active_ingredient_unit, 'spl' || part AS spl_id, package_description,
    marketing_start_date, marketing_end_date, '' AS billing_unit, 'bronze1' AS meta_run_id
  FROM products JOIN packages USING (part))
"""
UNIFIED_SQL = f"""{LISTED_SQL},
nsde AS (SELECT lpad(CAST(l_partkey AS VARCHAR), 5, '0') || lpad(CAST(l_suppkey AS VARCHAR), 4, '0')
      || CASE l_returnflag WHEN 'R' THEN '01' WHEN 'A' THEN '02' ELSE '03' END AS ndc_11,
    CASE WHEN max(l_linestatus) = 'O' THEN '' ELSE 'N-' || l_partkey END AS proprietary_name,
    CASE WHEN max(l_quantity) > 25 THEN 'KIT' END AS dosage_form, 'NDA' AS marketing_category,
    CASE WHEN max(l_quantity) > 25 THEN 'APP' || l_partkey ELSE '' END AS application_number, '' AS product_type,
    CASE WHEN max(l_quantity) > 25 THEN strftime(max(l_shipdate), '%Y-%m-%d') END AS marketing_start_date,
    CASE WHEN max(l_quantity) > 25 THEN NULL ELSE strftime(max(l_shipdate), '%Y-%m-%d') END AS marketing_end_date,
    CASE WHEN max(l_quantity) > 25 THEN 'EA' END AS billing_unit
  FROM lineitem GROUP BY l_partkey, l_suppkey, l_returnflag),
unified AS (SELECT coalesce(l.ndc_11, n.ndc_11) AS ndc_11,
    coalesce(nullif(n.marketing_category, ''), l.marketing_category) AS marketing_category,
    coalesce(nullif(n.product_type, ''), l.product_type) AS product_type,
    coalesce(nullif(n.proprietary_name, ''), l.proprietary_name) AS proprietary_name,
    coalesce(nullif(n.dosage_form, ''), l.dosage_form) AS dosage_form,
    coalesce(nullif(n.application_number, ''), l.application_number) AS application_number,
    l.dea_schedule, l.package_description, l.active_numerator_strength, l.active_ingredient_unit, l.spl_id,
    coalesce(n.marketing_start_date, l.marketing_start_date) AS marketing_start_date,
    coalesce(n.marketing_end_date, l.marketing_end_date) AS marketing_end_date,
    coalesce(nullif(n.billing_unit, ''), l.billing_unit) AS billing_unit,
    n.ndc_11 IS NOT NULL AS nsde_flag, coalesce(l.meta_run_id, 'run1') AS meta_run_id
  FROM listed l FULL JOIN nsde n ON l.ndc_11 = n.ndc_11)
"""
_HASHED = ", ".join(
    f"CAST({c} AS VARCHAR)" if c == "nsde_flag" else f"coalesce({c}, '')" for c in ds.FDA_BUSINESS
)
FIRST_LOAD_SQL = f"""{UNIFIED_SQL},
single AS (SELECT * FROM unified WHERE ndc_11 IN (SELECT ndc_11 FROM unified GROUP BY 1 HAVING count(*) = 1)),
hashed AS (SELECT *, md5(concat_ws('|', {_HASHED})) AS content_hash FROM single),
gold AS (SELECT ndc_11, substr(ndc_11, 1, 5) AS ndc_5, proprietary_name, dea_schedule, marketing_start_date, nsde_flag,
    content_hash, '2050-01-01' AS active_from, '9999-12-31' AS active_to, 'current' AS status,
    'silver.fda_all_ndcs' AS source_file, meta_run_id AS source_run_id, '2050-01-01' AS run_date, 'run1' AS run_id
  FROM hashed)
"""
GOLD_COLUMNS = [
    "ndc_11", "ndc_5", "proprietary_name", "dea_schedule", "marketing_start_date", "nsde_flag",
    "content_hash", "active_from", "active_to", "status", "source_file", "source_run_id",
    "run_date", "run_id",
]


def unified(spark: SparkSession, sf_dir: str, single: bool = False) -> DataFrame:
    listed = staged(
        fda.listed_packages(products(spark, sf_dir), packages(spark, sf_dir)), "listed-packages"
    )
    return fda.unified_codes(staged(nsde(spark, sf_dir), "nsde"), listed, RUN_ID, single=single)


def first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version of all codes; without stored rows to hold, repeated codes need not be merged to be rejected."""
    merged = staged(unified(spark, sf_dir, single=True), "unified-codes")
    rows = fda.snapshot(merged, "fda_all_ndcs", RUN_DATE)
    return fda.versioned(None, rows, RUN_DATE, RUN_ID)


@query("listed_packages", f"WITH {LISTED_SQL} SELECT * FROM listed")
def listed_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(fda.listed_packages(products(spark, sf_dir), packages(spark, sf_dir)))


@query("unified_codes", f"WITH {UNIFIED_SQL} SELECT * FROM unified")
def unified_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(unified(spark, sf_dir))


@query("fda_first_load", f"WITH {FIRST_LOAD_SQL} SELECT * FROM gold")
def fda_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(first_load(spark, sf_dir).select(*GOLD_COLUMNS))


@query("controlled_items", f"""WITH {FIRST_LOAD_SQL}
SELECT ndc_11, proprietary_name, dea_schedule, marketing_start_date FROM gold WHERE dea_schedule IS NOT NULL""")
def controlled_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(fda.controlled_items(first_load(spark, sf_dir)))


def _land(df: DataFrame, folder: str, names: dict[str, str], file: str, separator: str) -> None:
    """Write a typed stand-in as the delimited file it would arrive as, compressed."""
    back = {rule["target_name"]: source for source, rule in names.items()}
    df.select(*[
        (F.date_format(c, "yyyyMMdd") if kind == "date" else F.col(c)).alias(back[c])
        for c, kind in df.dtypes if c in back
    ]).write.csv(folder + file, header=True, sep=separator, compression="gzip")


DAILY_SQL = f"""{FIRST_LOAD_SQL}
SELECT ndc_11, ndc_5, proprietary_name, dea_schedule, marketing_start_date, nsde_flag, active_from, active_to, status,
  source_file, 'run1' AS source_run_id, run_date, run_id FROM gold
"""


@query("daily_flow", f"WITH {DAILY_SQL}")
def daily_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed files through all layers to the stored table."""
    from stratalake.sinks.versioned import VersionedTable

    base = scratch_path(spark, "daily")
    layout = daily.Layout(f"{base}/raw", f"{base}/bronze", f"{base}/silver", f"{base}/gold")
    drop = files.run_path(layout.raw, RUN_ID)
    _land(products(spark, sf_dir), drop, ds.PRODUCTS_SCHEMA, "product.txt", ds.CDER_DELIMITER)
    _land(packages(spark, sf_dir), drop, ds.PACKAGES_SCHEMA, "package.txt", ds.CDER_DELIMITER)
    _land(nsde(spark, sf_dir), drop, ds.NSDE_SCHEMA, next(iter(ds.NSDE_FILES)), ds.NSDE_DELIMITER)
    daily.run_daily(spark, layout, RUN_ID, RUN_DATE)
    stored = VersionedTable(spark, f"{layout.gold}/fda_all_ndcs", ds.FDA_KEY, ds.FDA_BUSINESS).read()
    wanted = [c for c in GOLD_COLUMNS if c != "content_hash"]
    return iso_dates(stored.filter(is_open()).select(*wanted))
