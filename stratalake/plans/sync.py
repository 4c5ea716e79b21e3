"""The serving flow: codesets to record and search items."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import columns, search
from stratalake.operators.items import record_changes, search_changes, single_write, token_refresh
from stratalake.plans import datasets as ds
from stratalake.plans import serving
from stratalake.session import staged
from stratalake.sinks import items as sink
from stratalake.sinks.item_store import ItemStore

# Kinds of items in the store.
RECORDS, TOKENS = "record", "search"
# A code that is mapped to several products has one record, that of the last product.
RECORD_ORDER = ["rxnorm_rxcui"]
LOAD_TIME = "meta_sync_timestamp"


def run_sync(spark: SparkSession, codesets: DataFrame, path: str, run_id: str) -> dict:
    """Replace all items and return how many were written of each kind.

    The old items of a kind go when the new ones are complete, so readers never
    meet a store without search items.  A write that fails ends the job; what it
    wrote is counted from the files.
    """
    records = serving.codeset_records(codesets, F.current_timestamp())
    index = staged(serving.codeset_index(codesets), "token-index")
    tokens = search.search_items(index, "DRUG")
    counts = {}
    for kind, wanted in ((TOKENS, tokens), (RECORDS, records)):
        sink.write_items(wanted, path, kind, order=RECORD_ORDER if kind == RECORDS else None)
        counts[f"{kind}_written"] = sink.read_items(spark, path, kind).count()
    return {"run_id": run_id, **counts}


def codeset_changes(before: DataFrame, after: DataFrame, run_id: str) -> DataFrame:
    """Puts and deletes of record and search items that turn one state of the codesets into the next.

    Entities with the same rows on both sides go first; records and tokens are made of the others alone.
    Both frames are read twice; pass stored ones.
    """
    before, after = _differing(before, after)

    def records(codesets: DataFrame) -> DataFrame:
        return single_write(serving.codeset_records(codesets, F.lit(run_id)), RECORD_ORDER)

    changes = record_changes(records(before), records(after), ignore=[LOAD_TIME, "meta_run_id"])
    # Where one side has a field that the other lacks, only differences in the common ones touch an entity.
    fields = [[c for c in ds.SEARCHABLE_FIELDS.values() if c in side.columns] for side in (before, after)]
    touched = None if fields[0] == fields[1] else _entities(before, after, ds.SEARCHABLE_FIELDS.values())
    refresh = token_refresh(serving.codeset_index(before), serving.codeset_index(after), touched, "entity_id")
    return changes.unionByName(search_changes(refresh, "DRUG"))


def _differing(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both states without the entities that have the same rows in both; as they are where one has none."""
    if before.isEmpty() or after.isEmpty():
        return before, after
    touched = staged(_entities(before, after, [*ds.CODESET_FDA, *ds.CODESET_RXNORM, "meta_run_id"]), "changed-entities")

    def of_touched(codesets: DataFrame) -> DataFrame:
        return staged(codesets.join(touched, serving.codeset_entity() == touched.entity_id, "left_semi"), "changed-codesets")

    return of_touched(before), of_touched(after)


def _entities(before: DataFrame, after: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Entities whose rows differ in the columns: rows of either side that the other has not as often."""
    fields = [c for c in columns if c in before.columns and c in after.columns]

    def marked(codesets: DataFrame, side: int) -> DataFrame:
        return codesets.select(
            serving.codeset_entity().alias("entity_id"), F.md5(F.to_json(F.struct(*fields))).alias("h"), F.lit(side).alias("side"))

    both = marked(before, -1).unionByName(marked(after, 1))
    return both.groupBy("entity_id", "h").agg(F.sum("side").alias("side")).filter("side <> 0").select("entity_id").distinct()


def run_sync_batch(
    store: ItemStore, before: DataFrame, after: DataFrame, batch_id: str, batch_order: str,
) -> dict:
    """Bring the store from one state of the codesets to the next by one batch of changed items."""
    return store.apply(codeset_changes(before, after, batch_id), batch_id, batch_order)


def gold_codesets(
    codes: DataFrame, mappings: DataFrame, products: DataFrame, run_id: str
) -> DataFrame:
    """Codesets from the current rows of the three versioned tables."""
    current_products = columns.add_prefix(serving.current_only(products), "rxnorm_")
    return serving.drug_codesets(
        serving.current_only(codes), serving.current_only(mappings), current_products, run_id
    )
