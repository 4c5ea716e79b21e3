"""The monthly flow: concept release to products, code mappings and drug classes."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import columns, quality
from stratalake.plans import concepts
from stratalake.plans import datasets as ds
from stratalake.plans.daily import Layout, apply_snapshot
from stratalake.session import staged
from stratalake.sinks import tables
from stratalake.sinks.versioned import VersionedTable
from stratalake.sources import documents, files

# The versioned tables by name, with key and hashed columns.
GOLD_TABLES = {
    "rxnorm_products": (ds.PRODUCTS_KEY, ds.PRODUCTS_BUSINESS),
    "rxnorm_ndc_mappings": (ds.MAPPINGS_KEY, ds.MAPPINGS_BUSINESS),
    "rxnorm_product_classifications": (ds.CLASSES_KEY, ds.CLASSES_BUSINESS),
}

# Tables of a release that the products are made from.
REQUIRED_TABLES = ("RXNCONSO", "RXNREL", "RXNSAT")


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a layer's table and go on from what was written."""
    tables.overwrite(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_monthly(
    spark: SparkSession, layout: Layout, release_files: Mapping[str, str], run_id: str,
    run_date: str, release_date: str, responses: DataFrame | None = None,
    buckets: int | None = None,
) -> dict[str, dict]:
    """One run; returns the statistics of each versioned table.

    ``release_files`` maps the files of the release to where they landed,
    ``responses`` holds the landed drug-class answers (``product_rxcui``,
    ``product_tty``, ``body``).
    """
    frames = files.load_positional_set(
        spark, release_files, ds.POSITIONAL_LAYOUTS, ds.POSITIONAL_LAYOUTS, run_id, release_date
    )
    missing = [t for t in REQUIRED_TABLES if t not in frames]
    if missing:
        raise quality.QualityError(f"the release lacks rows of {missing}")
    bronze = {
        name: stored(df, posixpath.join(layout.bronze, "rxnorm", name))
        for name, df in frames.items()
    }
    silver = {
        "rxnorm_products": stored(
            concepts.drug_products(bronze["RXNCONSO"], bronze["RXNREL"], bronze["RXNSAT"]),
            posixpath.join(layout.silver, "rxnorm_products"),
        )
    }
    silver["rxnorm_ndc_mappings"] = stored(
        concepts.named_mappings(bronze["RXNSAT"], silver["rxnorm_products"]),
        posixpath.join(layout.silver, "rxnorm_ndc_mappings"),
    )
    snapshots = {
        "rxnorm_products": concepts.product_snapshot(silver["rxnorm_products"], "rxnorm_products"),
        "rxnorm_ndc_mappings": concepts.mapping_snapshot(
            silver["rxnorm_ndc_mappings"], "rxnorm_ndc_mappings", run_date
        ),
    }
    unheard: dict[str, DataFrame] = {}
    if responses is not None:
        asked = columns.require_key(responses, "product_rxcui")
        readable, unreadable = documents.split_responses(asked)
        rejected_path = posixpath.join(layout.bronze, "rejects", "rxclass_responses")
        if tables.write_rejects(unreadable, rejected_path, run_id):
            # Their products keep the classes that they had.
            unheard["rxnorm_product_classifications"] = unreadable.select(F.col("product_rxcui").alias("rxcui"))
        members = stored(
            documents.drug_class_rows(readable, run_id).distinct(),
            posixpath.join(layout.silver, "rxclass_drug_members"),
        )
        snapshots["rxnorm_product_classifications"] = concepts.class_snapshot(
            quality.require_rows(members, "drug classes"), "rxclass_drug_members", run_date
        )
    statistics = {}
    for name, snapshot in snapshots.items():
        key, business = GOLD_TABLES[name]
        gold = VersionedTable(
            spark, posixpath.join(layout.gold, name), key, business, buckets, name if buckets else None
        )
        statistics[name] = apply_snapshot(
            gold, snapshot, posixpath.join(layout.gold, "rejects", name), run_date, run_id, unheard.get(name)
        )
    return statistics


def load_classes(
    spark: SparkSession, layout: Layout, document_path: str, run_id: str,
    min_rows: int = ds.CLASS_MIN_ROWS,
) -> DataFrame:
    """The class list: parsed, checked and kept as one small file."""
    checked = staged(documents.read_checked_documents(spark, document_path, documents.CLASS_LIST_SCHEMA), "class-documents")
    parsed, unreadable = files.split_malformed(checked)
    if not unreadable.isEmpty():
        # The list counts as complete, so a part of it must not pass for the whole.
        raise quality.QualityError(f"unreadable class list in {unreadable.first().source_file}")
    rows = documents.class_rows(parsed, run_id)
    quality.gate_completeness(
        rows, ds.CLASS_REQUIRED, ds.CLASS_CRITICAL, ds.CLASS_MAX_MISSING, min_rows
    )
    path = posixpath.join(layout.bronze, "rxclass")
    tables.overwrite(rows, path, single_file=True)
    return spark.read.schema(rows.schema).parquet(path)
