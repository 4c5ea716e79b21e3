"""Arriving snapshots as a stream into a versioned table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from stratalake.operators.quality import QualityError
from stratalake.sinks.versioned import VersionedTable


def version_stream(snapshots: DataFrame, table: VersionedTable, day: str, landing: str) -> DataStreamWriter:
    """Writer that versions each day's snapshot once its rows are complete.

    ``day`` is a text column with the snapshot that a row belongs to (``yyyy-MM-dd``).  A micro-batch may
    hold a part of a snapshot, or several: rows are kept under ``landing`` by micro-batch, and a day is
    versioned when rows of a later day have come; :func:`version_last` ends the last one.  A batch
    replayed after a failure replaces its own rows, and a day that was versioned is not versioned
    again.  Rows that come for a versioned day fail the stream, as its snapshot was not complete.
    """
    schema = snapshots.schema

    def load(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        done = newest_day(table)
        if done is not None and not batch.filter(F.col(day) <= done).isEmpty() and not _landed(batch.sparkSession, landing, number):
            raise QualityError(f"rows of a snapshot up to {done}, which is versioned")
        batch.write.mode("overwrite").parquet(f"{landing}/batch={number}")
        _version(batch.sparkSession, table, day, landing, schema, last=False)

    return snapshots.writeStream.foreachBatch(load)


def version_last(spark: SparkSession, table: VersionedTable, day: str, landing: str, schema: StructType) -> None:
    """Version what has landed to the last day, once no more rows of it will come."""
    _version(spark, table, day, landing, schema, last=True)


def newest_day(table: VersionedTable) -> str | None:
    return table.commits().agg(F.max("run_date")).first()[0]


def _landed(spark: SparkSession, landing: str, number: int) -> bool:
    """Whether a micro-batch has been written before."""
    try:
        spark.read.parquet(f"{landing}/batch={number}")
    except AnalysisException:
        return False
    return True


def _version(spark: SparkSession, table: VersionedTable, day: str, landing: str, schema: StructType, last: bool) -> None:
    rows = spark.read.schema(schema).parquet(f"{landing}/batch=*")
    done = newest_day(table)
    waiting = rows if done is None else rows.filter(F.col(day) > done)
    days = sorted(r[0] for r in waiting.select(day).distinct().collect())
    for snapshot in days if last else days[:-1]:
        table.apply(rows.filter(F.col(day) == snapshot).drop(day), snapshot, f"stream_{snapshot}")
