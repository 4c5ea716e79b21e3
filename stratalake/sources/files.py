"""Landed files: delimited, positional, by run and by release."""

from __future__ import annotations

import logging
import posixpath
import re
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.casting import release_stamp
from stratalake.operators.columns import apply_schema, stamp
from stratalake.operators.quality import require_rows
from stratalake.session import staged

_RUN_FOLDER = re.compile(r"/run_id=([^/]+)/")

log = logging.getLogger(__name__)


def run_path(base: str, run_id: str) -> str:
    """Folder of one raw drop."""
    return f"{base.rstrip('/')}/run_id={run_id}/"


def table_path(base: str, table: str, tables: Iterable[str]) -> str:
    """``base/<table>/`` for a data set with several tables, else ``base/``."""
    several = len(set(tables)) > 1
    return posixpath.join(base, table) + "/" if several else base.rstrip("/") + "/"


def read_delimited(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """File with a header; every column is text.  Fails on a file without rows."""
    df = spark.read.csv(path, header=True, inferSchema=False, sep=delimiter)
    return require_rows(df, path)


# Columns that checked readers add, and what a rejected record is kept with.
CORRUPT, SOURCE_FILE, SOURCE_BLOCK = "_corrupt_record", "_source_file", "_source_block"


def read_delimited_checked(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """As ``read_delimited``, with the text of records that do not fit the header, file and block.

    A record with too few or too many fields, or with broken quotes, has its text in
    ``_corrupt_record``.  Write the frame before ``split_malformed``: Spark does not answer for that
    column alone from the files.
    """
    names = read_delimited(spark, path, delimiter).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    # Without pruning, as a parser that skips fields does not notice that some are missing.
    raw = spark.read.option("columnPruning", False).csv(
        path, schema=schema, header=True, sep=delimiter, mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT, enforceSchema=True)
    return with_source(raw)


def with_source(df: DataFrame) -> DataFrame:
    """The frame with file and block that each record came from."""
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE),
                     F.col("_metadata.file_block_start").alias(SOURCE_BLOCK))


def split_malformed(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): every record is in one of them.

    A reject has file, block, the record's text and the reason ``malformed record``.
    """
    added = [CORRUPT, SOURCE_FILE, SOURCE_BLOCK]
    good = checked.filter(F.col(CORRUPT).isNull()).drop(*added)
    bad = checked.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(SOURCE_FILE).alias("source_file"), F.col(SOURCE_BLOCK).alias("source_block"),
        F.col(CORRUPT).alias("record"), F.lit("malformed record").alias("reason"))
    return good, bad


def read_positional(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headerless pipe file, quotes taken literally, columns named by position.

    Giving the schema avoids a pass to count fields; fields after the named ones,
    such as that of a trailing delimiter, are dropped by the parser.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, sep="|", quote="", escape="", header=False,
                          enforceSchema=True)


def match_files(paths: Iterable[str], mapping: Mapping[str, str]) -> dict[str, str]:
    """Table of each landed file, by base name without regard to case; others are left out."""
    tables = {posixpath.basename(name).lower(): table for name, table in mapping.items()}
    matched = {}
    for path in paths:
        base = posixpath.basename(path.replace("\\", "/")).lower()
        if base in tables:
            matched[path] = tables[base]
    return matched


def load_delimited_set(
    spark: SparkSession, folder: str, files: Mapping[str, str], run_id: str,
    delimiter: str = ",", schemas: Mapping[str, Mapping] | None = None,
) -> dict[str, DataFrame]:
    """Typed frames of a drop by table name, stamped with the run.

    Landed files are matched by base name without regard to case; several files of a table are
    read together.
    """
    schemas = schemas or {}
    matched = match_files(landed_paths(spark, folder), files)
    lost = {t for t in files.values() if t not in matched.values()}
    frames: dict[str, DataFrame] = {}
    # A configured file that did not land is read by its name, which fails with that name.
    named = [(posixpath.join(folder, n), t) for n, t in files.items() if t in lost]
    for path, table in sorted(matched.items()) + named:
        df = stamp(
            apply_schema(read_delimited(spark, path, delimiter), schemas.get(table)), meta_run_id=run_id
        )
        frames[table] = frames[table].unionByName(df, allowMissingColumns=True) if table in frames else df
    return {t: frames[t] for t in dict.fromkeys(files.values())}


def load_checked_set(
    spark: SparkSession, folder: str, files: Mapping[str, str], run_id: str,
    delimiter: str = ",", schemas: Mapping[str, Mapping] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """As ``load_delimited_set``, but records that do not fit their file's header are rejected.

    Returns the frames by table and one frame of rejects with the ``target_table`` each was meant for.
    Every file is parsed once, into a written table that both come from.
    """
    schemas = schemas or {}
    frames: dict[str, DataFrame] = {}
    rejects = None
    matched = match_files(landed_paths(spark, folder), files)
    lost = {t for t in files.values() if t not in matched.values()}
    named = [(posixpath.join(folder, n), t) for n, t in files.items() if t in lost]
    for path, table in sorted(matched.items()) + named:
        good, bad = split_malformed(staged(read_delimited_checked(spark, path, delimiter), "checked"))
        df = stamp(apply_schema(good, schemas.get(table)), meta_run_id=run_id)
        frames[table] = frames[table].unionByName(df, allowMissingColumns=True) if table in frames else df
        bad = bad.withColumn("target_table", F.lit(table))
        rejects = bad if rejects is None else rejects.unionByName(bad)
    return {t: frames[t] for t in dict.fromkeys(files.values())}, rejects


def landed_paths(spark: SparkSession, folder: str) -> list[str]:
    """Files of one drop: a listing, their content is not read."""
    listed = spark.read.format("binaryFile").load(folder).select("path")
    return [row.path for row in listed.collect()]


def load_positional_set(
    spark: SparkSession, files: Mapping[str, str], layouts: Mapping[str, Sequence[str]],
    wanted: Iterable[str], run_id: str, release_date: str,
) -> dict[str, DataFrame]:
    """Frames of the wanted tables that have a layout; empty ones are skipped.

    ``files`` maps a table name, or a file name that starts with it, to a path.
    """
    wanted = {w.upper() for w in wanted}
    frames = {}
    for name, path in files.items():
        table = name.rsplit(".", 1)[0].upper()
        if table not in wanted:
            continue
        if table not in layouts:
            log.warning("no column layout for %s, skipped", table)
            continue
        df = read_positional(spark, path, layouts[table])
        if df.isEmpty():
            log.warning("no data in %s, skipped", path)
            continue
        df = stamp(df, meta_run_id=run_id, meta_release_date=release_date)
        frames[table] = frames[table].unionByName(df) if table in frames else df
    return frames


def read_runs(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """All raw drops under a folder, with their ``run_id`` as a column."""
    return spark.read.option("basePath", base).schema(schema).parquet(base)


def latest_run(df: DataFrame) -> DataFrame:
    """Rows of the newest run that landed, of a frame from ``read_runs``.

    The newest id comes from the names of the files, which the session has listed anyway; no file
    is opened for it, and the scan has a literal filter on its partitions.
    """
    runs = {unquote(m.group(1)) for f in df.inputFiles() if (m := _RUN_FOLDER.search(f))}
    return df.filter(F.col("run_id") == max(runs)) if runs else df.limit(0)


def newest_release(df: DataFrame, name: str) -> DataFrame:
    """One row: file name with the latest ``MMddyyyy`` stamp, and that date."""
    stamped = df.select(F.col(name).alias("file_name"), release_stamp(F.col(name)).alias("released"))
    newest = F.max(F.struct("released", "file_name"))
    return stamped.filter(F.col("released").isNotNull()).agg(newest.alias("n")).select(
        "n.file_name", F.col("n.released").alias("release_date")
    )
