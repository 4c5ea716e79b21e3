"""Plain parquet outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import staged

CODEC = "zstd"


def overwrite(df: DataFrame, path: str, codec: str = CODEC, partition_by: str | None = None,
              single_file: bool = False) -> None:
    """Replace an output.  ``single_file`` is for small reference tables only."""
    if single_file:
        # Written first, so that only finished rows go through the one task.
        df = staged(df, "single-file").coalesce(1)
    writer = df.write.mode("overwrite").option("compression", codec)
    # Replace everything, also where the session defaults to dynamic overwrite.
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: str, codec: str = CODEC) -> None:
    """Replace only the partitions that the frame holds, each as a whole."""
    (
        df.write.mode("overwrite").option("compression", codec)
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def write_rejects(df: DataFrame, path: str, run_id: str, codec: str = CODEC) -> int:
    """Keep a run's rejected rows, replacing those of an earlier attempt; their number."""
    folder = f"{path.rstrip('/')}/reject_run_id={run_id}"
    overwrite(df, folder, codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder).count()


def append_batch(df: DataFrame, path: str, batch_id: str, codec: str = CODEC) -> None:
    """Add a staging batch under its own ``ingestion_batch_id``.

    Replacing that one partition makes a repeated write of a batch harmless.
    """
    replace_partitions(
        df.withColumn("ingestion_batch_id", F.lit(batch_id)), path, "ingestion_batch_id", codec
    )


def keep_raw_text(df: DataFrame, column: str, path: str, run_id: str) -> None:
    """Keep texts of one line each under the run; one with a line break fails the write.

    Whole documents go through ``keep_documents``.
    """
    value = F.when(F.col(column).rlike(r"[\r\n]"), F.raise_error(F.lit("a text with line breaks is no line"))).otherwise(F.col(column))
    df.select(value.alias("value"), F.lit(run_id).alias("run_id")).write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy("run_id").text(path)


def keep_documents(documents: DataFrame, path: str, run_id: str, codec: str = CODEC) -> None:
    """Keep whole documents byte for byte under the run, replacing those of an earlier attempt.

    ``documents`` has ``path`` (or another name), ``length`` and ``content``, as Spark's binary file
    source gives them; the digest is added.
    """
    kept = documents.select("path", "length", F.sha2("content", 256).alias("digest"), "content")
    replace_partitions(kept.withColumn("run_id", F.lit(run_id)), path, "run_id", codec)


def append_run_metrics(spark: SparkSession, path: str, metrics: DataFrame) -> None:
    """Add a one-row run summary."""
    metrics.coalesce(1).write.mode("append").parquet(path)
