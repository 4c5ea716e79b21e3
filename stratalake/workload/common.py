"""Helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso_dates(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which compares alike in every engine."""
    return df.select(*[
        F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, T.DateType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def text(name: str):
    """A number column as text."""
    return F.col(name).cast("string")
