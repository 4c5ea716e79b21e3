"""Two-pass external shuffle into shards of equal row counts.

Pass one scatters records uniformly by a seeded hash into buckets that fit in
memory; Spark's shuffle is the external store.  Pass two orders each bucket by
hash, so that the result does not depend on arrival, and shuffles it with a
seeded Fisher-Yates.  Buckets in turn form one sequence, which is cut into shards
whose counts differ by one at most (law ``rows``).

Equal rows share a hash.  They are counted first, by hash alone; rows that would
fill more than a part of a bucket are merged into (row, count) before the
scatter and numbered afterwards, so that copies spread over all buckets.

Rows may have NULLs, repeat or be empty; each gets a place of its own, and equal
rows are interchangeable.  An empty table gives an empty result.  Columns of any
name are carried along.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import column, fresh, row_hash

BUCKET_BYTES = 32 << 20
# Copies that are numbered by one row of a task.
RUN = 4096


def fisher_yates(count: int, seed: int) -> np.ndarray:
    """A permutation of ``count`` places: each in turn swaps with one not yet passed."""
    places = np.arange(count)
    random = np.random.Generator(np.random.PCG64(seed))
    for last, other in zip(range(count - 1, 0, -1),
                           random.integers(0, np.arange(count, 1, -1)).tolist()):
        places[last], places[other] = places[other], places[last]
    return places


def numbered_copies(docs: DataFrame, hash_col: str, copy_col: str, hot_rows: int) -> DataFrame:
    """``docs`` with the row hash, and a number that tells apart many equal rows.

    Only hashes of more than ``hot_rows`` rows are treated; their list has at most
    rows / hot_rows entries.
    """
    hashed = docs.withColumn(hash_col, row_hash(docs))
    counts = hashed.groupBy(column(hash_col).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    hot = [r["h"] for r in counts.where(F.col("n") > hot_rows).select("h").limit(10_001).collect()]
    if not hot:
        return hashed.withColumn(copy_col, F.lit(0).cast("long"))
    if len(hot) > 10_000:
        # More than a literal list should hold: merge all equal rows instead.
        many, few = hashed, None
    else:
        is_hot = column(hash_col).isin(hot)
        many, few = hashed.where(is_hot), hashed.where(~is_hot)
    count, run = fresh(hashed, "copies"), fresh(hashed, "run")
    keys = [column(c) for c in hashed.columns]
    many = (
        many.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
        .withColumn(run, F.explode(F.sequence(F.lit(0).cast("long"), column(count) - 1, F.lit(RUN).cast("long"))))
        # Runs of one row go to many tasks before they are written out row by row.
        .repartition(column(hash_col), column(run))
        .withColumn(copy_col, F.explode(F.sequence(column(run), F.least(column(run) + RUN, column(count)) - 1)))
        .drop(count, run)
    )
    return many if few is None else few.withColumn(copy_col, F.lit(0).cast("long")).unionByName(many)


def shuffle_into_shards(
    docs: DataFrame, shards: int, *, seed: int = 17, bucket_bytes: int = BUCKET_BYTES,
    min_buckets: int = 64, shard_col: str = "shard", slot_col: str = "slot",
) -> DataFrame:
    """``docs`` with its shard (0 to shards - 1) and its slot there (from 0, without gaps)."""
    texts = [f.name for f in docs.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = sum((F.coalesce(F.octet_length(column(c)), F.lit(0)) for c in texts), F.lit(16))
    total = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    rows, size = total["rows"], total["bytes"] or 0
    buckets = max(min_buckets, math.ceil(size / bucket_bytes))
    hash_col, copy_col, bucket, place = (fresh(docs, n) for n in ("row_hash", "copy", "bucket", "place"))
    # Equal rows may take up an eighth of a mean bucket before they are spread.
    hot_rows = max(64, rows // (8 * buckets))
    scattered = numbered_copies(docs, hash_col, copy_col, hot_rows).withColumn(
        bucket, F.pmod(F.xxhash64(F.lit(seed), column(hash_col), column(copy_col)), F.lit(buckets)))
    schema = T.StructType([*scattered.schema.fields, T.StructField(place, T.LongType())])

    def shuffled(records: pa.Table) -> pa.Table:
        order = np.lexsort((records.column(copy_col).to_numpy(), records.column(hash_col).to_numpy()))
        mixed = order[fisher_yates(len(order), seed * 1_000_003 + records.column(bucket)[0].as_py())]
        return records.take(pa.array(mixed)).append_column(place, pa.array(np.arange(len(mixed))))

    placed = scattered.groupBy(bucket).applyInArrow(shuffled, schema)
    sizes = scattered.groupBy(column(bucket)).agg(F.count(F.lit(1)).alias("n"))
    starts = bucket_starts(sizes, bucket, buckets)
    position = F.col("bucket_start") + column(place)
    whole, extra = divmod(rows, shards)
    # The first ``extra`` shards have one row more than the others.
    cut = extra * (whole + 1)
    shard = F.when(position < cut, F.floor(position / (whole + 1))).otherwise(
        extra + F.floor((position - cut) / max(whole, 1)))
    first = F.least(F.col("s"), F.lit(extra)) * (whole + 1) + F.greatest(F.col("s") - extra, F.lit(0)) * whole
    kept = [column(c).alias(c) for c in docs.columns if c.lower() not in (shard_col, slot_col)]
    return (
        placed.join(starts, bucket)
        .withColumn("s", shard.cast("long"))
        .select(*kept, F.col("s").cast("int").alias(shard_col), (position - first).alias(slot_col))
    )


def bucket_starts(sizes: DataFrame, bucket: str, buckets: int) -> DataFrame:
    """(bucket, rows before it), summed in two levels of about sqrt(buckets) rows each."""
    group = max(1, math.isqrt(buckets))
    in_group = Window.partitionBy("g").orderBy(column(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    grouped = sizes.withColumn("g", F.floor(column(bucket) / group))
    groups = grouped.groupBy("g").agg(F.sum("n").alias("n")).select(
        "g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = grouped.withColumn("inside", F.coalesce(F.sum("n").over(in_group), F.lit(0)))
    return inside.join(groups, "g").select(bucket, (F.col("base") + F.col("inside")).alias("bucket_start"))


def write_shards(sharded: DataFrame, path: str, shard_col: str = "shard", slot_col: str = "slot") -> None:
    """Write one folder per shard, its rows in slot order within each file."""
    sharded.repartitionByRange(column(shard_col), column(slot_col)).sortWithinPartitions(
        shard_col, slot_col).write.partitionBy(shard_col).parquet(path)
