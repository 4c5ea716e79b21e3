"""A versioned table kept as append-only parquet loads.

Each run adds one load with what it changed: the rows it opened (``status=current``)
and those it closed (``status=historical``).  Nothing is rewritten.  A stored row is
open unless a later load closed a row of its key, which reading finds by the key
alone, without a shuffle where the table is bucketed.  A load counts once its row
is in the commit table, so a run that dies half-way leaves files that nobody reads.
One writer at a time is assumed.

``content_hash`` is that of the columns hashed when the row was written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators import versioning as v
from stratalake.session import staged

_COMMIT_SCHEMA = (
    "version int, load_id string, run_date string, run_id string, "
    "new bigint, changed bigint, expired bigint, unchanged bigint, "
    "total_written bigint, row_schema string, hashed string"
)


@dataclass
class VersionedTable:
    """``path`` is a folder that all executors share.

    With ``buckets`` the rows are also bucketed by the key, under the catalog
    name ``table``: the open rows are then read as the join needs them and only
    the arriving snapshot is shuffled by the next run.  Buckets are not sorted,
    since a scan does not tell the join about their order.
    """

    spark: SparkSession
    path: str
    key: str | Sequence[str]
    business_columns: Sequence[str]
    buckets: int | None = None
    table: str | None = None

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")
        if self.buckets and not self.table:
            raise ValueError("a bucketed table needs a catalog name")

    # -- reading -----------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per run with its statistics, newest version last."""
        if not self._exists("commits"):
            return self.spark.createDataFrame([], _COMMIT_SCHEMA)
        rows = self.spark.read.schema(_COMMIT_SCHEMA).parquet(f"{self.path}/commits")
        return rows.orderBy("version")

    def _exists(self, folder: str) -> bool:
        try:
            self.spark.read.schema("x int").parquet(f"{self.path}/{folder}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table after the given run, by default the last; None before the first."""
        parts = self._open_and_closed(version)
        return None if parts is None else parts[0].unionByName(parts[1])

    def _open_and_closed(self, version: int | None = None) -> tuple[DataFrame, DataFrame] | None:
        """Open rows, bucketed by the key where the table is, and closed ones."""
        loads = [r for r in self.commits().collect() if version is None or r.version <= version]
        if not loads:
            return None
        schema = T.StructType.fromJson(json.loads(loads[-1].row_schema))
        rows = self._rows(schema).filter(F.col("load_id").isin([r.load_id for r in loads]))
        closed = rows.filter(F.col("status") == v.HISTORICAL)
        keys = v.as_keys(self.key)
        names = schema.fieldNames()
        if not any(r.changed or r.expired for r in loads):
            # No load has closed a row, as in a table of one load, so none needs to be looked up.
            return rows.filter(F.col("status") == v.CURRENT).select(*names), closed.select(*names)
        # Load ids begin with the version, so they sort by it.
        last_closed = closed.groupBy(*keys).agg(F.max("load_id").alias("_closed"))
        still_open = F.col("_closed").isNull() | (F.col("_closed") <= F.col("load_id"))
        opened = rows.filter(F.col("status") == v.CURRENT).join(last_closed, keys, "left").filter(still_open)
        return opened.select(*names), closed.select(*names)

    def rows_written(self) -> DataFrame:
        """(version, written): rows in the files of each load that counts."""
        loads = self.commits().select("version", "load_id", "row_schema").collect()
        if not loads:
            return self.spark.createDataFrame([], "version int, written bigint")
        schema = T.StructType.fromJson(json.loads(loads[-1].row_schema))
        counts = self._rows(schema).groupBy("load_id").agg(F.count(F.lit(1)).alias("written"))
        return self.commits().join(counts, "load_id").select("version", "written")

    def _rows(self, schema: T.StructType) -> DataFrame:
        """Rows of all loads with their ``load_id``.

        The schema comes from the commit, so no file footers are merged and a
        column that an old file lacks reads as NULL.
        """
        stored = T.StructType(
            [f for f in schema if f.name != "status"]
            + [T.StructField("load_id", T.StringType()), schema["status"]]
        )
        if not self.buckets:
            return self.spark.read.schema(stored).parquet(f"{self.path}/rows")
        self._register(stored)
        return self.spark.table(self.table)

    def _register(self, stored: T.StructType) -> None:
        """Name the files in the catalog, which is where Spark keeps bucketing."""
        spark = self.spark
        if spark.catalog.tableExists(self.table):
            if set(spark.table(self.table).columns) == set(stored.fieldNames()):
                spark.catalog.refreshTable(self.table)
                return
            spark.sql(f"DROP TABLE {self.table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
        keys = ", ".join(f"`{k}`" for k in v.as_keys(self.key))
        spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet "
            f"PARTITIONED BY (load_id, status) "
            f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}/rows'"
        )
        if self._exists("rows"):
            spark.catalog.recoverPartitions(self.table)

    # -- writing -----------------------------------------------------------

    def apply(
        self, incoming: DataFrame, run_date: str, run_id: str, skip_unchanged: bool = True,
        held: DataFrame | None = None, check_keys: bool = True,
    ) -> dict:
        """Version one complete snapshot and return the run's statistics.

        Keys in ``held`` arrived in rows that could not be used; their open rows stay.  Without
        ``check_keys`` the caller has seen to it that keys are complete and single, and a first load
        is written as it lies; later loads check on the way.

        A first narrow job joins keys and hashes only.  It finds bad keys before
        anything is written and tells what becomes of each key; a run without changes
        ends there.  The second job reads full rows of the touched keys alone and
        writes them.  A first load is written at once, its keys checked on the way.
        """
        commits = self.commits().collect()
        newest = max((r.run_date for r in commits), default=run_date)
        if run_date < newest:
            # Its closed rows would end before they began.
            raise ValueError(f"a run of {run_date} after one of {newest}")
        stored = self._open_and_closed()
        existing = None if stored is None else stored[0]
        version = 1 + max((r.version for r in commits), default=0)
        load_id = f"{version:08d}-{uuid.uuid4().hex[:8]}"
        keys = v.as_keys(self.key)
        hashed = json.dumps(v.business_columns_only(incoming, self.business_columns, keys))
        rehash = any(r.hashed != hashed for r in commits)
        if existing is not None:
            changes = staged(v.match_versions(
                existing, incoming, keys, self.business_columns, with_rows=False, held=held, rehash=rehash,
            ).select(*keys, "change"), "changes")
            stats = v.change_stats(changes).first().asDict()
            if stats["new"] + stats["changed"] + stats["expired"] == 0 and skip_unchanged:
                return {**stats, "version": None}
            touched = changes.filter(~F.col("change").isin(v.UNCHANGED, v.HELD)).select(*keys)
            existing = existing.join(touched, keys, "left_semi")
            incoming = incoming.join(touched, keys, "left_semi")
        rows = v.open_and_closed(
            v.match_versions(
                existing, incoming, keys, self.business_columns, check_keys or existing is not None, rehash=rehash),
            keys, run_date, run_id,
        )
        self._write(rows.withColumn("load_id", F.lit(load_id)))
        if existing is None:
            new = self._rows(rows.schema).filter(F.col("load_id") == load_id).count()
            changes = self.spark.range(new).select(F.lit(v.NEW).alias("change"))
            stats = v.change_stats(changes).first().asDict()
        commit = (
            version, load_id, run_date, run_id, stats["new"], stats["changed"],
            stats["expired"], stats["unchanged"], stats["total_written"], rows.schema.json(), hashed,
        )
        self.spark.createDataFrame([commit], _COMMIT_SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.path}/commits")
        return {**stats, "version": version}

    def _write(self, rows: DataFrame) -> None:
        if not self.buckets:
            rows.write.mode("append").option("compression", "zstd").partitionBy(
                "load_id", "status"
            ).parquet(f"{self.path}/rows")
            return
        # One file a bucket; only rows that a run opened or closed are moved.
        rows = rows.repartition(self.buckets, *v.as_keys(self.key))
        names = [n for n in rows.columns if n not in ("load_id", "status")]
        ordered = rows.select(*names, "load_id", "status")
        self._register(ordered.schema)
        ordered.write.mode("append").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
