"""Key-value items as files of JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.items import ITEM_KEY, item_partitions, single_write, to_documents
from stratalake.operators.quality import QualityError

# Share of failed token writes that fails a load.
MAX_TOKEN_FAILURES = 0.01


def write_items(
    df: DataFrame, path: str, item_kind: str, expected: int | None = None, per_task: int = 5000,
    per_file: int = 5_000_000, order: Sequence[str] | None = None,
) -> None:
    """Replace all items of a kind, also with none; other kinds stay.

    An item key is written once: of several items the last in ``order`` stays, a list of their
    attributes.  Without an order, different items under one key fail the write.

    Items are spread over tasks without regard to their keys: all search items
    share one PK.  With an ``expected`` count the writers get about ``per_task``
    items each, otherwise items are written where they are and only files are cut.
    """
    documents = to_documents(single_write(df, order).select(*df.columns))
    if expected is not None:
        documents = documents.repartition(item_partitions(expected, per_task))
    (
        documents.write.mode("overwrite").option("compression", "zstd")
        .option("maxRecordsPerFile", per_file)
        .option("partitionOverwriteMode", "static")
        .parquet(f"{path.rstrip('/')}/item_kind={item_kind}")
    )


def read_items(spark: SparkSession, path: str, item_kind: str | None = None) -> DataFrame:
    df = spark.read.schema("PK string, SK string, document string, item_kind string").parquet(path)
    return df if item_kind is None else df.filter(F.col("item_kind") == item_kind)


def write_outcome(
    expected: DataFrame, written: DataFrame, keys: list[str] = ITEM_KEY
) -> DataFrame:
    """One row: items ``written`` and ``failed``, by comparing keys with the output."""
    found = written.select(*keys).distinct().withColumn("_found", F.lit(True))
    return expected.select(*keys).distinct().join(found, keys, "left").agg(
        F.count("_found").alias("written"),
        F.count_if(F.col("_found").isNull()).alias("failed"),
    )


def gate_failures(records_failed: int, tokens_written: int, tokens_failed: int) -> None:
    """Fail the load on any lost record, or on more than 1% lost tokens."""
    if records_failed > 0 or tokens_failed > tokens_written * MAX_TOKEN_FAILURES:
        raise QualityError(f"excessive failures: {records_failed + tokens_failed} items")
