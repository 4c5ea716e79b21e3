"""Joining sources into one wide record."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import blank_to_null
from stratalake.operators import skew


def prefer(*choices: Column) -> Column:
    """First choice that is neither NULL nor ``''``; the last one is taken as it is."""
    return F.coalesce(*[blank_to_null(c) for c in choices[:-1]], choices[-1])


def full_outer_merge(
    left: DataFrame,
    right: DataFrame,
    key: str,
    text: Iterable[str] = (),
    dates: Iterable[str] = (),
    left_only: Iterable[str] = (),
    flag: str = "in_right",
    rows_per_task: int = skew.ROWS_PER_TASK,
    single: bool = False,
) -> DataFrame:
    """Union of two sources on a key, the right side preferred column by column.

    ``text`` columns take the right value unless it is NULL or ``''``, ``dates``
    unless it is NULL; ``left_only`` columns exist on the left.  ``flag`` says
    whether the right source has the record.  NULL keys match nothing.

    With ``single`` the result has no key that would come out more than once: one that a source repeats is
    left out before the join, which would multiply its rows, for callers that drop such keys anyway.
    """
    text, dates, left_only = list(text), list(dates), list(left_only)
    shared = text + dates
    left_side = left.select(key, *[F.col(c).alias(f"l_{c}") for c in shared + left_only])
    right_side = right.select(
        key, *[F.col(c).alias(f"r_{c}") for c in shared], F.lit(True).alias("_right")
    )
    if single:
        left_side, right_side = skew.single_rows(left_side, right_side, [key], rows_per_task)
    joined = skew.skew_join(left_side, right_side, [key], "full_outer", None if single else rows_per_task)
    # A right row without key matched nothing and counts as absent.
    present = F.col("_right").isNotNull() & F.col(key).isNotNull()
    return joined.select(
        key,
        *[prefer(F.col(f"r_{c}"), F.col(f"l_{c}")).alias(c) for c in text],
        *[F.coalesce(f"r_{c}", f"l_{c}").alias(c) for c in dates],
        *[F.col(f"l_{c}").alias(c) for c in left_only],
        present.alias(flag),
    )


def enrich(
    df: DataFrame, lookup: DataFrame, on: dict[str, str], where: Column | None = None
) -> DataFrame:
    """Left join on differently named keys, with an optional predicate on the lookup.

    ``on`` maps a column of ``df`` to one of ``lookup``; the lookup's own key
    columns are dropped.  The predicate filters the lookup, so rows without a
    qualifying partner stay.
    """
    side = lookup.filter(where) if where is not None else lookup
    side = side.withColumnsRenamed({theirs: f"_k_{ours}" for ours, theirs in on.items()})
    condition = [df[ours] == side[f"_k_{ours}"] for ours in on]
    return df.join(side, condition, "left").drop(*[f"_k_{ours}" for ours in on])


def assemble(base: DataFrame, key: str, attributes: Sequence[DataFrame]) -> DataFrame:
    """Left join attributes that have one row per key each."""
    return reduce(lambda wide, part: wide.join(part, key, "left"), attributes, base)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def filtered_or_all(filtered: DataFrame, everything: DataFrame, key: str, column: str) -> DataFrame:
    """Two-pass fallback: the filtered result, or the unfiltered one where it is empty."""
    fallback = everything.withColumnRenamed(column, "_fallback")
    return filtered.join(fallback, key, "left").select(
        key, prefer(F.col(column), F.col("_fallback")).alias(column)
    )


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows, enriched rows and their share in percent, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(column).alias("enriched"),
    ).withColumn(
        "enriched_pct",
        F.coalesce(F.try_divide(F.col("enriched") * 100.0, F.col("total")), F.lit(0.0)),
    )
