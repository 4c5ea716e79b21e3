"""Records and versions as key-value items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import key_path
from stratalake.operators.versioning import CURRENT
from stratalake.session import staged

ITEM_KEY = ["PK", "SK"]
# A hash that goes before the key wherever rows are sorted by it: the beginnings of keys are alike, hashes are not.
KEY_HASH = "_key"


def key_hash(*more: str) -> Column:
    return F.xxhash64(*ITEM_KEY, *more).alias(KEY_HASH)


def record_items(
    df: DataFrame, entity: Column, kind: str, columns: Sequence[str], synced_at: Column
) -> DataFrame:
    """Latest record per entity: ``<kind>#<id>`` / ``METADATA#latest`` plus attributes."""
    return df.filter(entity.isNotNull()).select(
        key_path(kind, entity).alias("PK"),
        F.lit("METADATA#latest").alias("SK"),
        *columns,
        synced_at.alias("meta_sync_timestamp"),
    )


def version_items(df: DataFrame, entity: str, kind: str) -> DataFrame:
    """Every version as an item: ``V#CURRENT`` for the open row, ``V#<active_from>`` else.

    Of versions that began on one day all but the last ended on it; those carry their version
    id, too, so that each has a key of its own.
    """
    return df.select(
        key_path("ITEM", kind, F.col(entity)).alias("PK"),
        F.when(F.col("status") == CURRENT, "V#CURRENT").otherwise(_closed_version()).alias("SK"),
        "*",
    )


def _closed_version() -> Column:
    """Sort key of a closed row."""
    day = F.concat(F.lit("V#"), F.date_format("active_from", "yyyy-MM-dd"))
    return F.when(F.col("active_from") < F.col("active_to"), day).otherwise(
        F.concat(day, F.lit("#"), F.col("version_id"))
    )


def record_refresh(changes: DataFrame, entity: str, kind: str) -> DataFrame:
    """Items to put after a batch, from the rows that it opened or closed.

    Each touched entity gets its ``V#CURRENT`` anew: the open row, or, where the batch left none,
    the row closed last, with ``is_current`` false and the day it ended.  Closed rows are put
    under their own day.
    """
    columns = changes.columns
    newest = F.struct(F.col("status") == CURRENT, "active_to", "active_from", "version_id")
    latest = changes.groupBy(entity).agg(F.max_by(F.struct(*columns), newest).alias("_l")).select("_l.*")
    closed = changes.filter(F.col("status") != CURRENT)
    return latest.withColumn("SK", F.lit("V#CURRENT")).unionByName(
        closed.withColumn("SK", _closed_version())
    ).select(
        key_path("ITEM", kind, F.col(entity)).alias("PK"), "SK",
        ((F.col("SK") == "V#CURRENT") & (F.col("status") == CURRENT)).alias("is_current"), *columns,
    )


def last_write_wins(df: DataFrame, order: Sequence[str], key: Sequence[str] = ITEM_KEY) -> DataFrame:
    """One row per item key, the one with the greatest ``order`` values.

    An aggregate, not a window: tasks keep one row per key before the shuffle, so
    a key with very many writes is never gathered in one place.
    """
    rest = [c for c in df.columns if c not in key]
    winner = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(F.xxhash64(*key).alias(KEY_HASH), *key).agg(winner.alias("_w")).select(
        *key, *[F.col(f"_w.{c}").alias(c) for c in rest]
    )


def single_write(df: DataFrame, order: Sequence[str] | None, key: Sequence[str] = ITEM_KEY) -> DataFrame:
    """One row per key: the last in ``order``; rows of a key without an order must be equal, or the job fails."""
    if order:
        return last_write_wins(df, order, key)
    if set(df.columns) == set(key):
        return df.distinct()
    row = F.struct(*[c for c in df.columns if c not in key])
    message = F.concat_ws(" ", F.lit("several writes without an order under"), *key)
    one = F.when(F.min(row).eqNullSafe(F.max(row)), F.max(row)).otherwise(F.raise_error(message))
    return df.groupBy(F.xxhash64(*key).alias(KEY_HASH), *key).agg(one.alias("_w")).select(*key, "_w.*")


def single_writes(df: DataFrame, order: Sequence[str] | None) -> DataFrame:
    """``single_write`` of a stored frame by item key, which shuffles hashes of keys alone and not the rows.

    Only rows under a hash that occurs more than once are gathered by their key.
    """
    hashed = df.withColumn(KEY_HASH, key_hash())
    repeated = staged(
        hashed.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(KEY_HASH), "repeated-hashes")
    if repeated.isEmpty():
        return df
    once = hashed.join(repeated, KEY_HASH, "left_anti").drop(KEY_HASH)
    several = hashed.join(repeated, KEY_HASH, "left_semi").drop(KEY_HASH)
    return staged(once.unionByName(single_write(several, order)), "single-writes")


def to_documents(df: DataFrame, key: Sequence[str] = ITEM_KEY) -> DataFrame:
    """(PK, SK, document): attributes as JSON without NULLs, dates as ISO text."""
    return df.select(*key, F.to_json(F.struct(*df.columns)).alias("document"))


def record_changes(before: DataFrame, after: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """(PK, SK, operation, document) that turn the items ``before`` into those ``after``.

    Both sides are read once and meet as fingerprints, the later one with its documents, so leave out
    beforehand what is known to be alike.  Keys are single on either side.  Attributes in ``ignore``,
    such as the time of the load, make no change.
    """
    compared = F.md5(F.to_json(F.struct(*[c for c in after.columns if c not in (*ITEM_KEY, *ignore)])))
    old = before.select(*ITEM_KEY, compared.alias("old"))
    new = after.select(*ITEM_KEY, compared.alias("new"), F.to_json(F.struct(*after.columns)).alias("document"))
    sides = old.unionByName(new, allowMissingColumns=True).groupBy(key_hash(), *ITEM_KEY).agg(
        *[F.max(c).alias(c) for c in ("old", "new", "document")]).filter(~F.col("old").eqNullSafe(F.col("new")))
    # An item without a whole key cannot be put.
    return sides.filter("new is null or (PK is not null and SK is not null)").select(
        *ITEM_KEY, F.when(F.col("new").isNull(), "delete").otherwise("put").alias("operation"), "document")


def search_changes(refresh: DataFrame, kind: str) -> DataFrame:
    """(PK, SK, operation, document) of the rows of ``token_refresh``."""
    keys = refresh.select(
        F.lit(f"SEARCH#{kind}").alias("PK"),
        key_path("token", F.col("token"), F.col("field"), kind, F.col("entity_id")).alias("SK"), "operation",
    )
    return keys.withColumn("document", F.when(F.col("operation") == "put", F.to_json(F.struct(*ITEM_KEY))))


def token_refresh(
    before: DataFrame, after: DataFrame, actions: DataFrame | None, entity: str
) -> DataFrame:
    """(PK, SK, operation): search items to ``put`` or ``delete`` for the changed entities.

    ``before`` and ``after`` are token indexes, ``actions`` the batch actions with
    the entity's column; without them all entities count.  Tokens that stay are left alone.
    """
    def of_touched(index: DataFrame) -> DataFrame:
        index = index.withColumn("entity_id", F.col("entity_id").cast("string"))
        if actions is None:
            return index
        touched = actions.select(F.col(entity).cast("string").alias("entity_id")).distinct()
        return index.join(touched, "entity_id", "left_semi")

    sides = (
        of_touched(before).withColumn("_side", F.lit(-1))
        .unionByName(of_touched(after).withColumn("_side", F.lit(1)))
        .groupBy("entity_id", "field", "token").agg(F.sum("_side").alias("_side"))
    )
    return sides.filter("_side <> 0").select(
        "entity_id", "field", "token",
        F.when(F.col("_side") > 0, "put").otherwise("delete").alias("operation"),
    )


def not_yet_applied(items: DataFrame, applied: DataFrame) -> DataFrame:
    """Items whose (key, batch, fingerprint) was not loaded before."""
    return items.join(applied, [*ITEM_KEY, "batch_id", "fingerprint"], "left_anti")


def item_partitions(items: int, per_partition: int = 5000, at_least: int = 4) -> int:
    """Write tasks for a number of items."""
    return max(at_least, items // per_partition)
