"""A store of key-value items that takes batches of puts and deletes.

Items lie in a fixed number of buckets by the hash of PK and SK together, since all search items
share one PK.  A batch reads the keys of the buckets that it touches and rewrites only those with a
change, as whole partitions.  A write carries the order of its batch, and the later batch keeps a
key whichever comes first, so batches may be repeated and may arrive late.  A delete stays in its
bucket as a row without a document, against puts of earlier batches that are still to come.

Once the items are written, the batch enters its writes (PK, SK, fingerprint) in the ledger, a
partition for each batch.  A batch that is sent again finds them there and touches no bucket, so
nothing needs a filter over the keys of a batch.  One that died in between has no such entries; the
buckets that it had finished hold its order already, and only the others are rewritten.

One writer at a time: two batches at once could rewrite the same bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.items import ITEM_KEY, KEY_HASH, key_hash, single_writes
from stratalake.session import staged
from stratalake.sinks.tables import CODEC

PUT, DELETE = "put", "delete"
_ITEM = "PK string, SK string, document string, batch_order string, batch_id string, bucket int"
_LEDGER = "PK string, SK string, fingerprint string, batch_id string"


def operation_fingerprint() -> Column:
    return F.md5(F.concat_ws("|", "operation", F.coalesce("document", F.lit(""))))


class ItemStore:
    """Items under ``path``, in ``buckets`` partitions, which stay as many for good."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        known = self._read("layout", "buckets int").first()
        if known is None:
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{self.path}/layout")
        elif known.buckets != buckets:
            raise ValueError(f"{self.path} has {known.buckets} buckets, not {buckets}")

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            # The limit tells the planner that there is nothing to join.
            return self.spark.createDataFrame([], schema).limit(0)

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Stored rows, deletes included, of some buckets or all."""
        stored = self._read("items", _ITEM)
        return stored if buckets is None else stored.filter(F.col("bucket").isin(list(buckets)))

    def items(self) -> DataFrame:
        """(PK, SK, document) of all items."""
        return self.rows().filter("document is not null").select(*ITEM_KEY, "document")

    def ledger(self, batch_id: str) -> DataFrame:
        return self._read("ledger", _LEDGER).filter(F.col("batch_id") == batch_id)

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*ITEM_KEY), F.lit(self.buckets).cast("long")).cast("int")

    def apply(
        self, operations: DataFrame, batch_id: str, batch_order: str, order: Sequence[str] | None = None,
    ) -> dict:
        """Apply a batch and say what it did.

        ``operations`` has PK, SK, ``operation`` (``put`` or ``delete``) and ``document``; of several
        with one key the last in ``order`` counts, and without an order they must be equal.
        ``batch_order`` sorts as text, batches of one order by their id.  The result counts
        operations that were not in the ledger, those that changed the store, and buckets and rows
        that were rewritten.
        """
        stored = staged(operations.select(
            *ITEM_KEY, "operation", F.when(F.col("operation") == PUT, F.col("document")).alias("document"), *(order or []),
        ), "item-operations")
        wanted = single_writes(stored, order).select(
            *ITEM_KEY, "document", operation_fingerprint().alias("fingerprint"), self.bucket_of().alias("bucket"),
            F.lit(batch_order).alias("batch_order"), F.lit(batch_id).alias("batch_id"),
        )
        pending = self._pending(wanted, self.ledger(batch_id))
        changes = self._changes(pending, batch_id, batch_order)
        # At most as many values as there are buckets.
        touched = sorted(r.bucket for r in changes.select("bucket").distinct().collect())
        if touched:
            self.rewrite(changes, touched)
        new = pending.select(*ITEM_KEY, "fingerprint", "batch_id")
        counted = pending.agg(F.count(F.lit(1))).first()[0]
        if counted:
            # Appended when the items are in place, in one commit; entries that repeat do no harm.
            new.write.mode("append").option("compression", CODEC).partitionBy("batch_id").parquet(f"{self.path}/ledger")
        return {
            "batch_id": batch_id, "pending": counted, "changed": changes.count(), "buckets": len(touched),
            "rewritten": self.rows(touched).count() if touched else 0,
        }

    def _pending(self, wanted: DataFrame, ledger: DataFrame) -> DataFrame:
        """Operations that the ledger has not; they are compared without their documents."""
        if ledger.isEmpty():
            return wanted
        entry = [key_hash("fingerprint"), *ITEM_KEY, "fingerprint"]
        names = [KEY_HASH, *ITEM_KEY, "fingerprint"]
        waiting = staged(wanted.select(*entry).join(ledger.select(*entry), names, "left_anti"), "item-entries")
        every, left = wanted.withColumn(KEY_HASH, key_hash("fingerprint")), waiting.toDF(*[f"_w_{n}" for n in names])
        # A key with a NULL is in no ledger and stays, too.
        same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_w_{n}")) for n in names])
        return staged(every.join(left, same, "left_semi").drop(KEY_HASH), "item-batch")

    def _changes(self, pending: DataFrame, batch_id: str, batch_order: str) -> DataFrame:
        """Operations that are later than what their key holds; only keys and orders are read.

        Only rows of this batch and of later ones can stand against them, mostly none.
        """
        touched = sorted(r.bucket for r in pending.select("bucket").distinct().collect())
        later = (F.col("batch_order") > batch_order) | (
            (F.col("batch_order") == batch_order) & (F.col("batch_id") >= batch_id))
        held = self.rows(touched).filter(later).select(key_hash(), *ITEM_KEY)
        if held.isEmpty():
            return pending
        names, arriving = [KEY_HASH, *ITEM_KEY], pending.withColumn(KEY_HASH, key_hash())
        # First the held keys that arrive, so that of few operations and many held keys the few are sent around.
        against = held.join(arriving.select(*names), names, "left_semi")
        return staged(arriving.join(against, names, "left_anti").drop(KEY_HASH), "item-changes")

    def rewrite(self, changes: DataFrame, buckets: Sequence[int]) -> None:
        """Replace buckets by what they hold with the changed keys put in."""
        kept = self.rows(buckets).withColumn(KEY_HASH, key_hash()).join(
            changes.select(key_hash(), *ITEM_KEY), [KEY_HASH, *ITEM_KEY], "left_anti")
        columns = [*ITEM_KEY, "document", "batch_order", "batch_id", "bucket"]
        merged = kept.select(*columns).unionByName(changes.filter(F.col("bucket").isin(list(buckets))).select(*columns))
        (
            merged.repartition("bucket").write.mode("overwrite").option("compression", CODEC)
            .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.path}/items")
        )
