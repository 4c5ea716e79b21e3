"""Slowly changing history, type 2.

A versioned table holds one open row per business key (``status='current'``,
``active_to='9999-12-31'``) and the closed rows of the past.  A run compares a
complete snapshot with the open rows through one full outer join on the key;
keys are unique on both sides, so no key can be hot in it.  Closed rows of the
past never enter the join.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.hashing import fingerprint, name_based_id
from stratalake.session import staged

log = logging.getLogger(__name__)

# Open end of a validity interval, row states, and the columns
# that never take part in change detection.
OPEN_END = "9999-12-31"
CURRENT, HISTORICAL = "current", "historical"
VERSION_COLUMNS = ["version_id", "content_hash", "active_from", "active_to", "status"]
RUN_COLUMNS = ["run_date", "run_id"]
VOLATILE_COLUMNS = [
    "run_date", "run_id", "source_run_id", "meta_run_id", "source_file", "version_id",
    "content_hash", "active_from", "active_to", "status", "updated_at", "created_at",
]
NEW, CHANGED, EXPIRED, UNCHANGED = "NEW", "CHANGED", "EXPIRED", "UNCHANGED"
# Open rows whose key arrived, but in rows that could not be used.
HELD = "HELD"

# Type changes that a column may go through from one run to the next.
_WIDENINGS = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"),
    ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"),
}


def as_keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def business_columns_only(
    df: DataFrame, columns: Sequence[str], key: str | Sequence[str] = ()
) -> list[str]:
    """Columns that may be hashed: no keys, no run or version metadata.

    Unknown columns and an empty result are errors.
    """
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"business columns not in the input: {unknown}")
    barred = set(VOLATILE_COLUMNS) | set(as_keys(key))
    removed = [c for c in columns if c in barred]
    if removed:
        log.warning("left out of the content hash: %s", removed)
    kept = [c for c in columns if c not in barred]
    if not kept:
        raise ValueError("no business columns remain for the content hash")
    return kept


def checked_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The same rows; the job fails while running if a key is NULL or repeats.

    The guard numbers rows within a key as a running count, without buffering a
    group, and leaves the rows partitioned and sorted as the join that follows
    needs them, so it costs no shuffle of its own.
    """
    keys = as_keys(key)
    missing = F.lit(False)
    for name in keys:
        missing = missing | F.col(name).isNull()
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    guard = (
        F.when(missing, F.raise_error(F.lit("NULL business key in the snapshot")))
        .when(F.col("_nth") > 1, F.raise_error(F.lit("business key repeats in the snapshot")))
        .otherwise(F.lit(True))
    )
    return df.withColumn("_nth", nth).filter(guard).drop("_nth")


def split_bad_keys(df: DataFrame, key: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows): rejects have a NULL key or share their key.

    Keys alone are counted, and repeated ones written first: where they are few, joins broadcast them by the
    size of their files, and no row is shuffled.  Pass stored rows.
    """
    keys = as_keys(key)
    complete = df.filter(_all_present(keys))
    repeated = staged(
        complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys), "repeated-keys")
    usable = complete.join(repeated, keys, "left_anti").select(*df.columns)
    rejected = df.filter(~_all_present(keys)).unionByName(
        complete.join(repeated, keys, "left_semi").select(*df.columns))
    return usable, rejected


def with_reason(rejected: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rejected rows with ``reject_reason``: a key that is missing or that repeats."""
    return rejected.withColumn(
        "reject_reason", F.when(_all_present(as_keys(key)), "repeated key").otherwise("missing key"))


def held_keys(rejected: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Complete keys among the rejects: they arrived, so their open rows must not be closed."""
    keys = as_keys(key)
    return rejected.filter(_all_present(keys)).select(*keys).distinct()


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in keys:
        present = present & F.col(name).isNotNull()
    return present


def _agreed_type(column: str, old: T.DataType | None, new: T.DataType | None) -> T.DataType:
    if old is None or new is None or old == new:
        return new if old is None else old
    pair = (old.simpleString(), new.simpleString())
    if pair in _WIDENINGS:
        return new
    if pair[::-1] in _WIDENINGS:
        return old
    raise ValueError(f"column {column!r} cannot change from {pair[0]} to {pair[1]}")


def next_schema(existing: DataFrame | None, incoming: DataFrame) -> T.StructType:
    """Fields of the next table: stored order first, added columns before the version columns.

    A source column named like a version column is an error, as the table could not keep it.
    """
    managed = VERSION_COLUMNS + RUN_COLUMNS
    reserved = [c for c in incoming.columns if c in VERSION_COLUMNS]
    if reserved:
        raise ValueError(f"source columns have names of version columns: {reserved}")
    old = {f.name: f.dataType for f in existing.schema} if existing is not None else {}
    new = {f.name: f.dataType for f in incoming.schema if f.name not in managed}
    names = [n for n in old if n not in managed] + [n for n in new if n not in old]
    fields = [T.StructField(n, _agreed_type(n, old.get(n), new.get(n))) for n in names]
    kinds = {"active_from": T.DateType(), "active_to": T.DateType()}
    fields += [T.StructField(n, kinds.get(n, T.StringType())) for n in managed]
    return T.StructType(fields)


def match_versions(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str | Sequence[str],
    business_columns: Sequence[str],
    check_keys: bool = True,
    with_rows: bool = True,
    held: DataFrame | None = None,
    rehash: bool = False,
) -> DataFrame:
    """(key, change, _old, _new): open rows against the snapshot.

    ``_old`` and ``_new`` are structs of the stored and the arriving row, NULL
    where a side is missing; without ``with_rows`` they hold the hash alone, so
    that only keys and hashes are shuffled.  When the snapshot brings a business column that
    the table lacks, stored rows are hashed anew with that column empty, so that
    only rows with a value in it count as changed.  ``rehash`` does so whenever the hashed
    columns differ from those that the stored hashes were made of.  Open rows of ``held`` keys
    stay as they are instead of expiring.
    """
    keys = as_keys(key)
    schema = next_schema(existing, incoming)
    managed = set(VERSION_COLUMNS + RUN_COLUMNS)
    payload = [f for f in schema if f.name not in managed]
    hashed = business_columns_only(incoming, business_columns, keys)

    def shaped(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
        return df.select(*[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in fields
        ])

    def packed(df: DataFrame, name: str) -> DataFrame:
        columns = df.columns if with_rows else ["content_hash"]
        return df.select(*keys, F.struct(*columns).alias(name))

    arriving = shaped(incoming, payload)
    arriving = arriving.withColumn("content_hash", fingerprint(arriving, hashed))
    if not with_rows:
        arriving = arriving.select(*keys, "content_hash")
    if check_keys:
        arriving = checked_keys(arriving, keys)
    new = packed(arriving, "_new")
    if existing is None:
        stored = shaped(incoming.limit(0), list(schema))
        return new.select(
            *keys, F.lit(NEW).alias("change"),
            F.lit(None).cast(stored.schema).alias("_old"), "_new",
        )
    evolved = rehash or any(c not in existing.columns for c in hashed)
    stored = shaped(existing.filter(F.col("status") == CURRENT), list(schema))
    if evolved:
        stored = stored.withColumn("content_hash", fingerprint(stored, hashed))
    old = packed(stored, "_old")
    joined = old.join(new, keys, "full_outer")
    if held is None:
        joined = joined.withColumn("_held", F.lit(False))
    else:
        joined = joined.join(held.select(*keys, F.lit(True).alias("_held")), keys, "left")
    change = (
        F.when(F.col("_old").isNull(), NEW)
        .when(F.col("_new").isNull() & F.coalesce("_held", F.lit(False)), HELD)
        .when(F.col("_new").isNull(), EXPIRED)
        .when(F.col("_old.content_hash") == F.col("_new.content_hash"), UNCHANGED)
        .otherwise(CHANGED)
    )
    return joined.select(*keys, change.alias("change"), "_old", "_new")


def open_and_closed(
    matched: DataFrame, key: str | Sequence[str], run_date: str, run_id: str
) -> DataFrame:
    """Rows that follow from a match: kept, closed by this run, or opened by it."""
    keys = as_keys(key)
    fields = matched.schema["_old"].dataType.fieldNames()
    today = F.lit(run_date).cast("date")
    carried = set(matched.schema["_new"].dataType.fieldNames())

    closing = {
        "active_to": today, "status": F.lit(HISTORICAL),
        "run_date": F.lit(run_date), "run_id": F.lit(run_id),
    }
    opening = {
        "version_id": name_based_id(
            *[F.col(k) for k in keys], F.date_format(today, "yyyy-MM-dd"),
            F.col("_new.content_hash"), F.lit(run_id),
        ),
        "active_from": today, "active_to": F.lit(OPEN_END).cast("date"),
        "status": F.lit(CURRENT), "run_date": F.lit(run_date), "run_id": F.lit(run_id),
    }
    kept = F.struct(*[F.col(f"_old.{n}").alias(n) for n in fields])
    closed = F.struct(*[closing.get(n, F.col(f"_old.{n}")).alias(n) for n in fields])
    opened = F.struct(*[
        (F.col(f"_new.{n}") if n in carried else opening[n]).alias(n) for n in fields
    ])
    rows = (
        F.when(F.col("change").isin(UNCHANGED, HELD), F.array(kept))
        .when(F.col("change") == EXPIRED, F.array(closed))
        .when(F.col("change") == NEW, F.array(opened))
        .otherwise(F.array(closed, opened))
    )
    return matched.select(F.inline(rows))


def scd2_apply(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str | Sequence[str],
    business_columns: Sequence[str],
    run_date: str,
    run_id: str,
    check_keys: bool = True,
    held: DataFrame | None = None,
    rehash: bool = False,
) -> DataFrame:
    """The complete next table after one snapshot; ``held`` keys keep their open rows."""
    matched = match_versions(
        existing, incoming, key, business_columns, check_keys, held=held, rehash=rehash
    )
    rows = open_and_closed(matched, key, run_date, run_id)
    if existing is None:
        return rows
    past = existing.filter(F.col("status") == HISTORICAL)
    past = past.select(*[
        (F.col(f.name) if f.name in past.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in rows.schema
    ])
    return past.unionByName(rows)


def change_stats(matched: DataFrame) -> DataFrame:
    """One row: new, changed, expired, unchanged, total_written, write_reduction_pct."""

    def counted(change: str) -> Column:
        return F.count_if(F.col("change") == change)

    counts = matched.agg(
        counted(NEW).alias("new"), counted(CHANGED).alias("changed"),
        counted(EXPIRED).alias("expired"), counted(UNCHANGED).alias("unchanged"),
    )
    written = F.col("new") + 2 * F.col("changed") + F.col("expired")
    incoming = F.col("new") + F.col("changed") + F.col("unchanged")
    return counts.withColumn("total_written", written).withColumn(
        "write_reduction_pct",
        F.coalesce(
            F.round(100.0 * (1 - F.try_divide(written.cast("double"), incoming * 2.0)), 1),
            F.lit(0.0),
        ),
    )


def as_of(df: DataFrame, day: str, mode: str = "half_open") -> DataFrame:
    """Rows valid on a day.

    A closed row ends on the day its successor starts.  ``half_open`` gives that
    day to the successor; ``closed`` is BETWEEN and returns both.
    """
    when = F.lit(day).cast("date")
    if mode == "closed":
        return df.filter(when.between(F.col("active_from"), F.col("active_to")))
    if mode != "half_open":
        raise ValueError(f"unknown mode {mode!r}")
    return df.filter((F.col("active_from") <= when) & (when < F.col("active_to")))


def is_open() -> Column:
    return F.col("active_to") == F.lit(OPEN_END).cast("date")


def history(df: DataFrame, condition: Column) -> DataFrame:
    """Versions of the selected keys, newest first, labelled CURRENT or EXPIRED."""
    labelled = df.filter(condition).withColumn(
        "version_status", F.when(is_open(), "CURRENT").otherwise("EXPIRED")
    )
    return labelled.orderBy(F.desc("active_from"), F.desc("active_to"))


def changes_on(df: DataFrame, day: str) -> DataFrame:
    """Rows opened or closed by the run of a day."""
    when = F.lit(day).cast("date")
    touched = (F.col("active_from") == when) | ((F.col("active_to") == when) & ~is_open())
    return df.filter((F.col("run_date") == day) & touched)


def discontinued(df: DataFrame, day: str, days: int = 30) -> DataFrame:
    """Rows closed within ``days`` before a day, latest first."""
    start = F.date_sub(F.lit(day).cast("date"), days)
    return df.filter(
        (F.col("active_to") >= start) & ~is_open() & (F.col("status") == HISTORICAL)
    ).orderBy(F.desc("active_to"))


def batch_actions(changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """(key, action): INSERT has only an open row, DELETE only closed ones, UPDATE both."""
    grouped = changes.groupBy(*as_keys(key)).agg(
        F.max(is_open()).alias("_open"), F.max(~is_open()).alias("_closed")
    )
    action = (
        F.when(F.col("_open") & F.col("_closed"), "UPDATE")
        .when(F.col("_open"), "INSERT")
        .otherwise("DELETE")
    )
    return grouped.select(*as_keys(key), action.alias("action"))


def status_summary(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows and distinct keys per status; keys are counted per (status, key) first."""
    per_key = df.groupBy("status", *as_keys(key)).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy("status").agg(
        F.sum("_n").alias("record_count"), F.count(F.lit(1)).alias("unique_keys")
    )
