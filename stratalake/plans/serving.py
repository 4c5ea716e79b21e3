"""Codesets, search items and record items for the serving store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators import columns, items, merge, search, skew
from stratalake.operators.versioning import CURRENT
from stratalake.plans import datasets as ds
from stratalake.session import staged


def drug_codesets(
    codes: DataFrame, mappings: DataFrame, products: DataFrame, run_id: str,
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> DataFrame:
    """Package codes, mappings and products side by side; either side may be missing.

    ``codes`` has plain column names, ``products`` the source prefix.  Codes meet
    products through their mapping; a product without any code keeps a row.  All codeset columns
    come out, those that no source has as NULL, so readers meet one schema whatever has arrived.
    """
    left = columns.add_prefix(codes, "fda_").withColumnRenamed("fda_ndc_11", "_code")
    bridge = mappings.select(
        F.col("ndc_11").alias("_code"), F.col("rxcui").alias("_product")
    ).distinct()
    right = products.withColumn("_product", F.col("rxnorm_rxcui"))

    # Read for the keys, the join and the codes without a mapping.
    mapped = staged(left.join(bridge, "_code", "left"), "mapped-codes")
    joined = skew.skew_join(
        mapped, right, ["_product"], "full_outer", rows_per_task
    ).withColumnRenamed("_code", "fda_ndc_11")
    present = set(joined.columns)
    wanted = [
        F.col(c) if c in present else F.lit(None).cast(ds.CODESET_TYPES.get(c, "string")).alias(c)
        for c in ds.CODESET_FDA + ds.CODESET_RXNORM
    ]
    return joined.select(*wanted, F.lit(run_id).alias("meta_run_id"))


def codeset_entity() -> Column:
    return search.entity_id("fda_ndc_11", "rxnorm_rxcui")


def codeset_index(codesets: DataFrame) -> DataFrame:
    """Token index over the searchable fields that the codesets have."""
    fields = {k: c for k, c in ds.SEARCHABLE_FIELDS.items() if c in codesets.columns}
    return search.token_index(codesets, codeset_entity(), fields)


def current_only(versions: DataFrame) -> DataFrame:
    """Only open rows are searchable."""
    return versions.filter(F.col("status") == CURRENT)


def codeset_records(codesets: DataFrame, synced_at: Column) -> DataFrame:
    wanted = [
        c for c in ds.CODESET_FDA + ds.CODESET_RXNORM + ["meta_run_id"] if c in codesets.columns
    ]
    return items.record_items(codesets, codeset_entity(), "DRUG", wanted, synced_at)
