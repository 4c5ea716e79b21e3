"""Projections, renames and row filters shared by all datasets."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.casting import quoted, typed
from stratalake.functions.text import blank_to_null

log = logging.getLogger(__name__)


def apply_schema(df: DataFrame, schema: Mapping[str, Mapping] | None) -> DataFrame:
    """Rename and cast by a declarative schema in one projection.

    Listed columns come first in schema order, the others follow untouched; a
    listed column that the input lacks is skipped with a warning.
    """
    if not schema:
        return df
    present = set(df.columns)
    listed = []
    for source, rule in schema.items():
        if source in present:
            listed.append(typed(quoted(source), rule).alias(rule["target_name"]))
        else:
            log.warning("column %r not in the input, skipped", source)
    others = [quoted(name) for name in df.columns if name not in schema]
    return df.select(*listed, *others)


def stamp(df: DataFrame, **literals: str | None) -> DataFrame:
    """Add literal lineage columns."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def find_column(df: DataFrame, name: str) -> str | None:
    """Name as the frame spells it, looked up without regard to case."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def is_active(flag: Column) -> Column:
    """NULL and ``''`` count as ``'N'``, and only ``'N'`` is active."""
    return F.coalesce(blank_to_null(flag), F.lit("N")) == "N"


def active_only(df: DataFrame, flag: str = "SUPPRESS") -> DataFrame:
    """Active rows; every row where the frame has no such flag."""
    found = find_column(df, flag)
    return df.filter(is_active(quoted(found))) if found else df


def exclude_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows holding ``value``; a NULL is kept."""
    return df.filter(~quoted(column).eqNullSafe(F.lit(value)))


def require_key(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.dropna(how="any", subset=list(columns))


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed(
        {c: c[len(prefix):] for c in df.columns if c.startswith(prefix)}
    )


def add_prefix(df: DataFrame, prefix: str, skip: Iterable[str] = ()) -> DataFrame:
    kept = set(skip)
    return df.select(
        *[quoted(c) if c in kept else quoted(c).alias(prefix + c) for c in df.columns]
    )


def rename_existing(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename those of the columns that exist, found without regard to case."""
    found = {find_column(df, old): new for old, new in names.items()}
    return df.withColumnsRenamed({old: new for old, new in found.items() if old})


def lowercase_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def gold_lineage(
    df: DataFrame, source_file: str, run_date: str, release_column: bool = False
) -> DataFrame:
    """Lineage names of the versioned layer.

    ``meta_run_id`` becomes ``source_run_id``; with ``release_column`` the
    release date is kept as ``source_release_date`` or set to the run date.
    """
    renamed = rename_existing(
        df, {"meta_run_id": "source_run_id", "meta_release_date": "source_release_date"}
    )
    if release_column and "source_release_date" not in renamed.columns:
        renamed = renamed.withColumn("source_release_date", F.lit(run_date))
    return renamed.withColumn("source_file", F.lit(source_file))


def contains_text(column: str, needle: str) -> Column:
    """Case-blind substring test."""
    return F.lower(quoted(column)).contains(needle.lower())


def split_valid(df: DataFrame, is_valid: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); a NULL verdict rejects."""
    verdict = F.coalesce(is_valid, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)
