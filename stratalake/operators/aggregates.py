"""Grouped summaries used by the datasets and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import joined_set


def set_text(value: Column, separator: str) -> Column:
    """Aggregate: sorted distinct values as one text, ``''`` for an all-NULL group."""
    return joined_set(F.collect_set(value), separator)


def wrapped_set_text(value: Column, empty_as_null: bool = True) -> Column:
    """Aggregate: ``Pack (a / b)``; an empty group is NULL, or ``Pack ()`` on request."""
    return wrap_pack(set_text(F.trim(value), " / "), empty_as_null)


def wrap_pack(names: Column, empty_as_null: bool = True) -> Column:
    wrapped = F.concat(F.lit("Pack ("), names, F.lit(")"))
    return F.when(names != "", wrapped) if empty_as_null else wrapped


def any_value(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    """One row per key; all its columns come from the same, smallest row.

    Rows whose first column is NULL are used only if there is no other.
    """
    picked = F.coalesce(
        F.min(F.when(F.col(columns[0]).isNotNull(), F.struct(*columns))),
        F.min(F.struct(*columns)),
    )
    return df.groupBy(*keys).agg(picked.alias("_p")).select(
        *keys, *[F.col(f"_p.{c}").alias(c) for c in columns]
    )


def has_any(value: Column) -> Column:
    """Aggregate: is there a non-NULL value?"""
    return F.count(value) > 0


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_groups(df: DataFrame, keys: Sequence[str], n: int, name: str = "count") -> DataFrame:
    """The ``n`` largest groups, ties in key order."""
    return group_counts(df, keys, name).orderBy(F.desc(name), *keys).limit(n)


def counts_and_distinct(
    df: DataFrame, keys: Sequence[str], entity: str, rows: str, entities: str
) -> DataFrame:
    """Rows and distinct entities per group.

    Counting per (group, entity) first spreads a hot group over its entities.
    """
    per_entity = df.groupBy(*keys, entity).agg(F.count(F.lit(1)).alias("_n"))
    return per_entity.groupBy(*keys).agg(
        F.sum("_n").alias(rows), F.count(entity).alias(entities)
    )


def rows_per_entity(
    df: DataFrame, keys: Sequence[str], entity: str, rows: str, entities: str,
    ratio: str, digits: int = 1,
) -> DataFrame:
    """Rows, distinct entities and their rounded ratio per group."""
    counted = counts_and_distinct(df, keys, entity, rows, entities)
    return counted.withColumn(
        ratio,
        F.round(F.try_divide(F.col(rows).cast("double"), F.col(entities)), digits),
    )


def distinct_per_group(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Distinct values per group, largest first."""
    return (
        df.select(*keys, value).distinct()
        .groupBy(*keys).agg(F.count(value).alias(name))
        .orderBy(F.desc(name), *keys)
    )


def repeated_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once."""
    return group_counts(df, keys, name).filter(F.col(name) > 1)
