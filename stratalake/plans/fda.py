"""Package codes from two regulators' files, merged and versioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import text
from stratalake.operators import columns, merge, skew, versioning
from stratalake.plans import datasets as ds

# Spellings under which the application number arrives.
_APPLICATION_NUMBER = ["application_number_or_citation", "application number or monograph id"]

_MERGED_TEXT = [
    "marketing_category", "product_type", "proprietary_name", "dosage_form",
    "application_number", "billing_unit",
]
_MERGED_DATES = ["marketing_start_date", "marketing_end_date"]
_LEFT_ONLY = [
    "dea_schedule", "package_description", "active_numerator_strength",
    "active_ingredient_unit", "spl_id", "meta_run_id",
]


def listed_packages(products: DataFrame, packages: DataFrame) -> DataFrame:
    """Packages with the attributes of their product, without excluded products.

    A product with very many packages is split by adaptive execution, which can
    do that for an inner join.
    """
    product = columns.exclude_value(products, "ndc_exclude_flag", "E").select(
        "product_id",
        F.col("marketing_category_name").alias("marketing_category"),
        F.col("product_type_name").alias("product_type"),
        "proprietary_name",
        F.col("dosage_form_name").alias("dosage_form"),
        "application_number", "dea_schedule", "active_numerator_strength",
        "active_ingredient_unit",
    )
    package = packages.select(
        "product_id",
        text.package_code(F.col("ndc_package_code")).alias("ndc_11"),
        "package_description",
        F.col("start_marketing_date").alias("marketing_start_date"),
        F.col("end_marketing_date").alias("marketing_end_date"),
        "meta_run_id",
    )
    return product.join(package, "product_id").select(
        "ndc_11", "marketing_category", "product_type", "proprietary_name", "dosage_form",
        "application_number", "dea_schedule", "active_numerator_strength",
        "active_ingredient_unit",
        text.part_of(F.col("product_id"), "_", 1).alias("spl_id"),
        "package_description", "marketing_start_date", "marketing_end_date",
        F.lit("").alias("billing_unit"),
        "meta_run_id",
    )


def unified_codes(
    nsde: DataFrame, listed: DataFrame, run_id: str,
    rows_per_task: int = skew.ROWS_PER_TASK, single: bool = False,
) -> DataFrame:
    """All codes of both sources; a row that only the second has carries ``run_id``.

    ``listed`` is the result of :func:`listed_packages`, best read from a table.  With ``single`` codes
    that would come out more than once are left out, as versioning takes none of them.
    """
    number = next((c for c in map(lambda n: columns.find_column(nsde, n), _APPLICATION_NUMBER) if c), None)
    if number is None:
        raise ValueError(f"none of {_APPLICATION_NUMBER} in the second source")
    right = nsde.withColumnRenamed(number, "application_number")
    merged = merge.full_outer_merge(
        listed, right, "ndc_11",
        text=_MERGED_TEXT, dates=_MERGED_DATES, left_only=_LEFT_ONLY, flag="nsde_flag",
        rows_per_task=rows_per_task, single=single,
    )
    return merged.select(
        "ndc_11", "marketing_category", "product_type", "proprietary_name", "dosage_form",
        "application_number", "dea_schedule", "package_description",
        "active_numerator_strength", "active_ingredient_unit", "spl_id",
        "marketing_start_date", "marketing_end_date", "billing_unit", "nsde_flag",
        F.coalesce("meta_run_id", F.lit(run_id)).alias("meta_run_id"),
    )


def snapshot(unified: DataFrame, source_table: str, run_date: str) -> DataFrame:
    """Unified codes with the versioned layer's lineage names and the labeler code."""
    renamed = columns.gold_lineage(unified, f"silver.{source_table}", run_date)
    return renamed.withColumn("ndc_5", text.labeler_code(F.col("ndc_11")))


def versioned(
    existing: DataFrame | None, snapshot_rows: DataFrame, run_date: str, run_id: str
) -> DataFrame:
    """Next versioned table; unusable keys (NULL or repeated) stay out, and open rows of theirs stay."""
    usable, rejected = versioning.split_bad_keys(snapshot_rows, ds.FDA_KEY)
    return versioning.scd2_apply(
        existing, usable, ds.FDA_KEY, ds.FDA_BUSINESS, run_date, run_id, check_keys=False,
        held=None if existing is None else versioning.held_keys(rejected, ds.FDA_KEY),
    )


def controlled_items(table: DataFrame) -> DataFrame:
    """Current items with a controlled-substance schedule, by schedule and name."""
    return (
        table.filter(
            (F.col("status") == versioning.CURRENT)
            & F.col("dea_schedule").isNotNull() & versioning.is_open()
        )
        .select("ndc_11", "proprietary_name", "dea_schedule", "marketing_start_date")
        .orderBy("dea_schedule", "proprietary_name", "ndc_11")
    )
