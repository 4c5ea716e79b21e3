"""The daily flow from landed files to the versioned code table."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators import quality, versioning
from stratalake.plans import datasets as ds
from stratalake.plans import fda
from stratalake.plans.together import run_together
from stratalake.session import staged
from stratalake.sinks import tables
from stratalake.sinks.versioned import VersionedTable
from stratalake.sources import files


@dataclass(frozen=True)
class Layout:
    """Folders of the layers, all on storage that every executor shares."""

    raw: str
    bronze: str
    silver: str
    gold: str


# Data sets of the drop with their files, and the columns that the merge needs of each table.
SOURCES = [("fda-nsde", ds.NSDE_FILES, ds.NSDE_DELIMITER), ("fda-cder", ds.CDER_FILES, ds.CDER_DELIMITER)]
REQUIRED = {
    "fda-nsde": [
        "ndc_11", "proprietary_name", "dosage_form", "marketing_category", "product_type",
        "marketing_start_date", "marketing_end_date", "billing_unit",
    ],
    "fda-products": [
        "product_id", "marketing_category_name", "product_type_name", "proprietary_name", "dosage_form_name",
        "application_number", "dea_schedule", "active_numerator_strength", "active_ingredient_unit",
        "ndc_exclude_flag",
    ],
    "fda-packages": [
        "product_id", "ndc_package_code", "package_description", "start_marketing_date", "end_marketing_date",
        "meta_run_id",
    ],
}


def load_bronze(
    spark: SparkSession, layout: Layout, run_id: str, dataset: str, mapping: Mapping[str, str],
    delimiter: str, strict: bool = False,
) -> tuple[dict[str, DataFrame], int]:
    """Bronze tables of a data set's drop, written and read back, and the number of rejected records.

    With ``strict`` records that do not fit their file's header are kept as rejects of the run
    instead of being filled up or cut.
    """
    raw = files.run_path(layout.raw, run_id)
    base = posixpath.join(layout.bronze, dataset)
    rejected = 0
    if strict:
        frames, rejects = files.load_checked_set(spark, raw, mapping, run_id, delimiter, ds.COLUMN_SCHEMAS)
        rejected = tables.write_rejects(rejects, posixpath.join(layout.bronze, "rejects", dataset), run_id)
    else:
        frames = files.load_delimited_set(spark, raw, mapping, run_id, delimiter, ds.COLUMN_SCHEMAS)
    written = {}
    for table, df in frames.items():
        path = files.table_path(base, table, mapping.values())
        tables.overwrite(df, path)
        written[table] = spark.read.schema(df.schema).parquet(path)
    return written, rejected


def catalog_bronze(spark: SparkSession, catalog: Mapping[str, str]) -> dict[str, DataFrame]:
    """Bronze tables by the names that the catalog knows them under.

    Tables and columns that are not there are named before any job starts.
    """
    unnamed = [t for t in REQUIRED if t not in catalog]
    if unnamed:
        raise quality.QualityError(f"no catalog name given for {unnamed}")
    quality.require_tables(spark, {catalog[t]: needed for t, needed in REQUIRED.items()})
    return {t: spark.table(catalog[t]) for t in REQUIRED}


def run_daily(
    spark: SparkSession, layout: Layout, run_id: str, run_date: str, buckets: int | None = None,
    catalog: Mapping[str, str] | None = None, strict: bool = False,
) -> dict:
    """One run: raw drop to bronze, merged silver, versioned gold; returns the statistics.

    Each layer is written and read back, so a later step starts from files and
    never from a lineage that would be computed again.  The drop's data sets load side by side.  With
    ``catalog``, names of bronze tables that other jobs have loaded, nothing is read from the drop.
    """
    bronze, malformed = {}, 0
    if catalog is not None:
        bronze = catalog_bronze(spark, catalog)
    else:
        loads = {
            dataset: partial(load_bronze, spark, layout, run_id, dataset, mapping, delimiter, strict)
            for dataset, mapping, delimiter in SOURCES
        }
        for written, rejected in run_together(spark, loads).values():
            bronze.update(written)
            malformed += rejected

    listed = staged(
        fda.listed_packages(bronze["fda-products"], bronze["fda-packages"]), "listed-packages"
    )
    unified = fda.unified_codes(bronze["fda-nsde"], listed, run_id)
    silver_path = posixpath.join(layout.silver, "fda_all_ndcs")
    tables.overwrite(unified, silver_path)
    silver = quality.require_rows(
        spark.read.schema(unified.schema).parquet(silver_path), silver_path
    )

    gold = VersionedTable(
        spark, posixpath.join(layout.gold, "fda_all_ndcs"), ds.FDA_KEY, ds.FDA_BUSINESS,
        buckets, "fda_all_ndcs" if buckets else None,
    )
    done = apply_snapshot(
        gold, fda.snapshot(silver, "fda_all_ndcs", run_date),
        posixpath.join(layout.gold, "rejects", "fda_all_ndcs"), run_date, run_id,
    )
    return {**done, "malformed": malformed} if strict else done


def apply_snapshot(
    gold: VersionedTable, snapshot: DataFrame, reject_path: str, run_date: str, run_id: str,
    unheard: DataFrame | None = None,
) -> dict:
    """Version the usable rows, keep the rejects of the run, and count them.

    Every row of the snapshot is used or rejected.  A key that arrived only in rejected rows is
    held: its open version stays open.  So do those of ``unheard`` entities, of which the run has
    learnt nothing; it has some of the key's columns.
    """
    usable, rejected = versioning.split_bad_keys(snapshot, gold.key)
    count = tables.write_rejects(versioning.with_reason(rejected, gold.key), reject_path, run_id)
    held = versioning.held_keys(rejected, gold.key) if count else None
    if unheard is not None and gold.commits().count():
        keys = versioning.as_keys(gold.key)
        silent = gold.read().filter(versioning.is_open()).join(unheard.distinct(), unheard.columns, "left_semi").select(*keys)
        held = staged(silent if held is None else held.select(*keys).unionByName(silent).distinct(), "held-keys")
    return {**gold.apply(usable, run_date, run_id, held=held, check_keys=False), "rejected": count}
