"""Data quality reports and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A load that must not go on."""


def completeness(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: ``total`` and, per required column, ``missing_<column>`` (NULL or empty)."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias(f"missing_{c}")
            for c in required
        ],
    )


def gate_completeness(
    df: DataFrame, required: Sequence[str], critical: Sequence[str],
    max_missing: float = 0.01, min_rows: int = 0,
) -> DataFrame:
    """Report of :func:`completeness`, or an error.  Runs one aggregate."""
    report = completeness(df, required)
    row = report.first()
    for column in critical:
        if row[f"missing_{column}"] > row["total"] * max_missing:
            raise QualityError(f"too many missing {column}: {row[f'missing_{column}']}")
    if row["total"] < min_rows:
        raise QualityError(f"{row['total']} rows, at least {min_rows} expected")
    return report


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The input itself, or an error if it is empty.  Reads at most one row."""
    if df.isEmpty():
        raise QualityError(f"no data found in {what}")
    return df


def code_validity(df: DataFrame, code: str, digits: int = 11, prefix: str = "ndc") -> DataFrame:
    """Add ``<prefix>_length``, ``<prefix>_is_numeric`` and ``<prefix>_is_valid``."""
    length, numeric = F.length(code), F.col(code).rlike("^[0-9]+$")
    return df.withColumns({
        f"{prefix}_length": length,
        f"{prefix}_is_numeric": numeric,
        f"{prefix}_is_valid": (length == digits) & numeric,
    })


def sample_per_reason(rejects: DataFrame, reason: str, k: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Up to ``k`` rejects of each reason, those of least hash: the same rows however they are dealt.

    Each task keeps its own first ``k`` of a reason before anything is shuffled, so a reason that
    holds most rejects sends no more than the others.  Equal rows have equal hashes and may all be kept.
    """
    drawn = F.md5(F.to_json(F.struct(*(columns or rejects.columns))))
    order = Window.partitionBy(reason).orderBy("_drawn", *(columns or []))
    return rejects.withColumn("_drawn", drawn).withColumn("_place", F.row_number().over(order)).filter(
        F.col("_place") <= k).drop("_drawn", "_place")


def validity_report(df: DataFrame, is_valid: Column) -> DataFrame:
    """One row: ``total``, ``valid``, ``invalid`` and the valid share in percent."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_valid).alias("valid")
    )
    return counted.select(
        "total", "valid", (F.col("total") - F.col("valid")).alias("invalid"),
        F.coalesce(
            F.round(F.try_divide(F.col("valid") * 100.0, F.col("total")), 1), F.lit(0.0)
        ).alias("valid_pct"),
    )


def require_tables(spark: SparkSession, expected: Mapping[str, Sequence[str]]) -> None:
    """Fail with every table that the catalog lacks, and every column that a table lacks.

    Only the catalog is asked; no job runs.
    """
    problems = [f"no table {t}" for t in missing_tables(spark, list(expected))]
    absent = {p.removeprefix("no table ") for p in problems}
    for name, wanted in expected.items():
        if name not in absent:
            known = {c.lower() for c in spark.table(name).columns}
            problems += [f"no column {c} in {name}" for c in wanted if c.lower() not in known]
    if problems:
        raise QualityError("sources are not ready: " + "; ".join(problems))


def missing_tables(spark: SparkSession, expected: Sequence[str]) -> list[str]:
    """Expected tables that the catalog does not have."""
    return [t for t in expected if not spark.catalog.tableExists(t)]
