"""Session construction and the shared working folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job wants, whatever the cluster.  Sizes (shuffle partitions, split
# sizes, memory) are left to the cluster; adaptive execution merges and splits.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task writes its few partitions side by side instead of sorting its rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(app: str = "stratalake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above, which ``conf`` may override."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors both see: ``spark.checkpoint.dir``, else one in the warehouse.

    The same rule for every master; nothing is kept on a machine's own disk unless these settings say so.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# Shuffle files of a query go when it ends, instead of when the driver collects its garbage.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: dict = {"lock": threading.Lock(), "users": 0, "before": None}


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries started within leave no shuffle files behind; for those whose result is written and read again.

    Steps may run side by side in one session: the last one out restores the setting.
    """
    with _releasing["lock"]:
        if not _releasing["users"]:
            _releasing["before"] = spark.conf.get(_RELEASE, None)
            spark.conf.set(_RELEASE, "true")
        _releasing["users"] += 1
    try:
        yield
    finally:
        with _releasing["lock"]:
            _releasing["users"] -= 1
            if not _releasing["users"]:
                if _releasing["before"] is None:
                    spark.conf.unset(_RELEASE)
                else:
                    spark.conf.set(_RELEASE, _releasing["before"])


def stored(
    df: DataFrame, path: str, partition_by: str | None = None, by: str | None = None, slices: int = 1,
    columns: list[str] | None = None,
) -> DataFrame:
    """The frame written to a new path and read back, its shuffle files released.

    With ``slices`` it is written in as many queries, one after the other, each of the rows under its share
    of the hashes of the column ``by``.  If ``by`` is a key of the joins and groups that the frame is made of,
    the optimiser filters their inputs, so a query shuffles its share of the rows and no two shares lie on disk
    at a time.  ``columns`` are those to be written, all by default.
    """
    kept = df.select(*columns) if columns else df
    with shuffles_released(df.sparkSession):
        for k in range(slices):
            share = df.filter(F.pmod(F.xxhash64(by), F.lit(slices)) == k) if slices > 1 else df
            # Named here, too, as a session that others have built may not have the settings above.
            writer = (share.select(*columns) if columns else share).write.mode("append" if k else "errorifexists").option(
                "compression", BASE_CONF["spark.sql.parquet.compression.codec"])
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(kept.schema).parquet(path)


def staged(
    df: DataFrame, label: str, partition_by: str | None = None, by: str | None = None, slices: int = 1,
) -> DataFrame:
    """The frame written to the shared folder and read back, in a folder for each value of a column if asked.

    Cuts the lineage for a result that several steps start from, and survives the
    loss of any executor.  For ``slices`` see ``stored``.
    """
    return stored(df, scratch_path(df.sparkSession, label), partition_by, by, slices)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that no frame is going to read any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
