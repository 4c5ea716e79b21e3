"""The item store: batches of changes, replays, late and repeated writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans import sync
from stratalake.session import scratch_path, staged
from stratalake.sinks import items as item_sink
from stratalake.sinks.item_store import ItemStore
from stratalake.workload import query
from stratalake.workload.common import table, text
from stratalake.workload.serving import tokens_sql

BUCKETS = 16
_CODE = "lpad(CAST(p_partkey AS VARCHAR), 11, '0')"
# Yesterday parts of size 7 did not exist, those of one brand had another name, and suppliers had codes.
STATES_SQL = f"""
today AS (SELECT {_CODE} AS code, p_name AS name, p_type AS kind FROM part),
yesterday AS (
  SELECT {_CODE} AS code, CASE WHEN p_brand = 'Brand#13' THEN 'old ' || p_name ELSE p_name END AS name, p_type AS kind
  FROM part WHERE p_size <> 7
  UNION ALL SELECT 'S' || s_suppkey, s_name, NULL FROM supplier),
changed AS (
  SELECT coalesce(t.code, y.code) AS code FROM today t FULL JOIN yesterday y ON t.code = y.code
  WHERE t.code IS NULL OR y.code IS NULL OR t.name IS DISTINCT FROM y.name OR t.kind IS DISTINCT FROM y.kind)
"""


def _index_sql(state: str) -> str:
    return "SELECT DISTINCT * FROM (" + " UNION ALL ".join(
        f"SELECT 'token#' || unnest({tokens_sql(column)}) || '#{label}#DRUG#' || code AS \"SK\" FROM {state}"
        for label, column in (("ndc", "code"), ("proprietary_name", "name"), ("rxnorm_str", "kind"))) + ")"


def states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Codesets of yesterday and today."""
    part = table(spark, sf_dir, "part")

    def codesets(code, name, kind):
        return [code.alias("fda_ndc_11"), name.alias("fda_proprietary_name"),
                F.lit(None).cast("string").alias("rxnorm_rxcui"), kind.alias("rxnorm_str")]

    code = F.lpad(text("p_partkey"), 11, "0")
    today = part.select(*codesets(code, F.col("p_name"), F.col("p_type")))
    name = F.when(F.col("p_brand") == "Brand#13", F.concat(F.lit("old "), "p_name")).otherwise(F.col("p_name"))
    gone = table(spark, sf_dir, "supplier").select(*codesets(
        F.concat(F.lit("S"), text("s_suppkey")), F.col("s_name"), F.lit(None).cast("string")))
    yesterday = part.filter("p_size <> 7").select(*codesets(code, name, F.col("p_type"))).unionByName(gone)
    # Dealt out, as a table may lie in one piece that a single task reads.
    return tuple(staged(state.repartition(*state.columns), "codesets") for state in (yesterday, today))


def filled(spark: SparkSession, sf_dir: str) -> tuple[ItemStore, DataFrame, DataFrame, list[dict]]:
    """A store filled with yesterday's items and brought to today's by one batch."""
    yesterday, today = states(spark, sf_dir)
    store = ItemStore(spark, scratch_path(spark, "store"), BUCKETS)
    nothing = yesterday.limit(0)
    done = [sync.run_sync_batch(store, nothing, yesterday, "b1", "2050-01-01"),
            sync.run_sync_batch(store, yesterday, today, "b2", "2050-01-02")]
    return store, yesterday, today, done


@query("sync_increment", f"""WITH {STATES_SQL}
SELECT 'DRUG#' || code AS "PK", 'METADATA#latest' AS "SK", name, kind,
  CASE WHEN code IN (SELECT code FROM changed) THEN 'b2' ELSE 'b1' END AS loaded_by FROM today
UNION ALL SELECT 'SEARCH#DRUG', "SK", NULL, NULL, NULL FROM ({_index_sql('today')})""")
def sync_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after a batch of changes holds what a refill would; unchanged records were not put again."""
    store, *_ = filled(spark, sf_dir)

    def attribute(name: str):
        return F.get_json_object("document", f"$.{name}")

    return store.items().select(
        "PK", "SK", attribute("fda_proprietary_name").alias("name"), attribute("rxnorm_str").alias("kind"),
        attribute("meta_sync_timestamp").alias("loaded_by"))


@query("sync_replay", f"""WITH {STATES_SQL},
old AS ({_index_sql('yesterday')}), new AS ({_index_sql('today')}),
first AS (SELECT (SELECT count(*) FROM yesterday) + (SELECT count(*) FROM old) AS n),
second AS (SELECT (SELECT count(*) FROM changed) + (SELECT count(*) FROM (SELECT * FROM old EXCEPT SELECT * FROM new))
  + (SELECT count(*) FROM (SELECT * FROM new EXCEPT SELECT * FROM old)) AS n)
SELECT 1 AS step, n AS pending, n AS changed FROM first UNION ALL SELECT 2, n, n FROM second
UNION ALL SELECT 3, 0, 0 UNION ALL SELECT 4, 0, 0
UNION ALL SELECT 5, (SELECT count(*) FROM supplier), 0""")
def sync_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches sent again write nothing, and puts of an older day do not undo later deletes."""
    store, yesterday, today, done = filled(spark, sf_dir)
    done.append(sync.run_sync_batch(store, yesterday, today, "b2", "2050-01-02"))
    done.append(sync.run_sync_batch(store, yesterday.limit(0), yesterday, "b1", "2050-01-01"))
    late = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("DRUG#S"), text("s_suppkey")).alias("PK"), F.lit("METADATA#latest").alias("SK"),
        F.lit("put").alias("operation"), F.lit("{}").alias("document"))
    done.append(store.apply(late, "b0", "2049-12-31"))
    return spark.createDataFrame(
        [(step, d["pending"], d["changed"]) for step, d in enumerate(done, 1)], "step int, pending bigint, changed bigint")


@query("items_last_write", """
SELECT 'CUSTOMER#' || o_custkey AS "PK", o_orderstatus AS "SK", CAST(o_orderkey AS BIGINT) AS o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def items_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several writes of an item the latest by a stated order is stored, whatever its text."""
    path = scratch_path(spark, "items")
    writes = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CUSTOMER#"), text("o_custkey")).alias("PK"), F.col("o_orderstatus").alias("SK"),
        "o_orderkey", "o_orderdate", "o_orderpriority")
    item_sink.write_items(writes, path, "record", order=["o_orderdate", "o_orderkey"])
    return item_sink.read_items(spark, path, "record").select(
        "PK", "SK", F.get_json_object("document", "$.o_orderkey").cast("bigint").alias("o_orderkey"))


@query("item_replace_empty", """SELECT 'C#' || c_custkey AS "PK", 'search' AS item_kind FROM customer""")
def item_replace_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing a kind by nothing empties it and leaves the others."""
    path = scratch_path(spark, "items")
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C#"), text("c_custkey")).alias("PK"), F.lit("METADATA#latest").alias("SK"), "c_name")
    for kind in ("record", "search"):
        item_sink.write_items(rows, path, kind)
    item_sink.write_items(rows.filter("c_name is null"), path, "record")
    return item_sink.read_items(spark, path).select("PK", "item_kind")
