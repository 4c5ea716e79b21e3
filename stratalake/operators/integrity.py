"""Checks on versioned tables; each returns its offenders, none when all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.aggregates import repeated_keys
from stratalake.operators.versioning import CURRENT, HISTORICAL, as_keys, is_open


def duplicate_current(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys with several open rows."""
    return repeated_keys(df.filter(is_open()), as_keys(key), "current_count")


def status_mismatches(df: DataFrame) -> DataFrame:
    """Rows whose status disagrees with their end date."""
    return df.filter(
        (is_open() & (F.col("status") != CURRENT))
        | (~is_open() & (F.col("status") != HISTORICAL))
    )


def interval_faults(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """(key, active_from, active_to, fault): OVERLAP with earlier rows or a GAP after them.

    Touching intervals are fine, and a zero-length interval touches.  Equal
    intervals are merged before the window, so what a window holds per key is
    bounded by the distinct day pairs, not by the rows of a hot key.
    """
    keys = as_keys(key)
    intervals = df.groupBy(*keys, "active_from", "active_to").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("active_from", "active_to")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = intervals.withColumn("_reached", F.max("active_to").over(earlier))
    repeats = (F.col("_n") > 1) & (F.col("active_from") < F.col("active_to"))
    fault = (
        F.when(repeats | (F.col("active_from") < F.col("_reached")), "OVERLAP")
        .when(F.col("active_from") > F.col("_reached"), "GAP")
    )
    return reached.select(*keys, "active_from", "active_to", fault.alias("fault")).filter(
        F.col("fault").isNotNull()
    )


def overlapping_pairs(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys whose closed-interval rows share a day, counted as the documented self-join does.

    That join reports each pair of versions of a key with ``a.from <= b.to`` and
    ``a.to >= b.from``.  Pairs are never built: per key, sorted starts and ends
    give the number of pairs that do not meet, and the rest meet.
    """
    keys = as_keys(key)
    marks = (
        df.select(*keys, F.explode(F.array(
            F.struct(F.col("active_from").alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
            F.struct(F.date_add("active_to", 1).alias("day"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
        )).alias("m"))
        .groupBy(*keys, F.col("m.day").alias("day"))
        .agg(F.sum("m.starts").alias("starts"), F.sum("m.ends").alias("ends"))
    )
    before = (
        Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    )
    apart = (
        marks.withColumn("_ended", F.sum("ends").over(before))
        .groupBy(*keys)
        .agg(
            F.sum("starts").alias("_rows"),
            F.sum(F.col("starts") * F.col("_ended")).alias("_apart"),
        )
    )
    pairs = (F.col("_rows") * (F.col("_rows") - 1) / 2).cast("bigint") - F.col("_apart")
    return apart.select(*keys, pairs.alias("overlaps")).filter(F.col("overlaps") > 0)
