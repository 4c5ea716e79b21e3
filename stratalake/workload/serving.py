"""Tokens, items and codesets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.hashing import fingerprint
from stratalake.functions.text import STOP_WORDS, tokens
from stratalake.operators import items, search
from stratalake.operators import versioning as v
from stratalake.plans import concepts as plan
from stratalake.plans import datasets as ds
from stratalake.plans import serving
from stratalake.session import scratch_path, staged
from stratalake.sinks import items as item_sink
from stratalake.workload import concepts, fda, query, versions
from stratalake.workload.common import iso_dates, table, text

_BREAK = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}/|]+"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def tokens_sql(column: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({column}), '{_BREAK}'), "
        f"lambda w: length(w) >= 3 AND w NOT IN ({_STOP}))"
    )


PART_FIELDS = {"name": "p_name", "brand": "p_brand", "kind": "p_type"}
PART_INDEX_SQL = "idx AS (" + " UNION ".join(
    f"SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS entity_id, '{label}' AS field, unnest({tokens_sql(column)}) AS token FROM part"
    for label, column in PART_FIELDS.items()
) + ")"


def part_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.token_index(table(spark, sf_dir, "part"), text("p_partkey"), PART_FIELDS)


@query("tokenise_documents", f"""
SELECT doc_id, CAST(len({tokens_sql('text')}) AS INTEGER) AS n_tokens,
  CAST(len(list_distinct({tokens_sql('text')})) AS INTEGER) AS n_distinct,
  md5(array_to_string({tokens_sql('text')}, ' ')) AS digest FROM documents
""")
def tokenise_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("doc_id", tokens(F.col("text")).alias("w"))
    return words.select(
        "doc_id", F.size("w").alias("n_tokens"), F.size(F.array_distinct("w")).alias("n_distinct"),
        F.md5(F.array_join("w", " ")).alias("digest"),
    )


@query("token_index", f"WITH {PART_INDEX_SQL} SELECT * FROM idx")
def token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_index(spark, sf_dir)


@query("search_items", f"""WITH {PART_INDEX_SQL}
SELECT 'SEARCH#PART' AS "PK", 'token#' || token || '#' || field || '#PART#' || entity_id AS "SK" FROM idx""")
def search_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_items(part_index(spark, sf_dir), "PART")


DOCUMENT_INDEX_SQL = f"""
doc AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS entity_id, unnest({tokens_sql('text')}) AS token FROM documents),
ask AS (SELECT DISTINCT item_id AS query_id, unnest({tokens_sql('text')}) AS token FROM benchmark),
need AS (SELECT query_id, count(*) AS n FROM ask GROUP BY 1)
"""


@query("search_documents", f"""WITH {DOCUMENT_INDEX_SQL}
SELECT query_id, entity_id, count(*) AS matched FROM ask JOIN doc USING (token) JOIN need USING (query_id)
GROUP BY query_id, entity_id, n HAVING count(*) = n""")
def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold every token of a benchmark passage."""
    index = search.token_index(table(spark, sf_dir, "documents"), text("doc_id"), {"text": "text"})
    queries = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    return search.search(queries, staged(index, "token-index"))


@query("search_records", f"""WITH {PART_INDEX_SQL},
ask AS (SELECT DISTINCT p_name AS query_id, unnest({tokens_sql('p_name')}) AS token FROM part),
need AS (SELECT query_id, count(*) AS n FROM ask GROUP BY 1),
entry AS (SELECT DISTINCT entity_id, token FROM idx),
hit AS (SELECT query_id, entity_id, count(*) AS matched FROM ask JOIN entry USING (token) JOIN need USING (query_id)
  GROUP BY query_id, entity_id, n HAVING count(*) = n)
SELECT query_id, entity_id, matched, p_brand FROM hit JOIN part ON CAST(p_partkey AS VARCHAR) = entity_id""")
def search_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose tokens include all tokens of each distinct part name."""
    parts = table(spark, sf_dir, "part")
    queries = parts.select(F.col("p_name").alias("query_id"), F.col("p_name").alias("query")).distinct()
    records = parts.select(text("p_partkey").alias("id"), "p_brand")
    index = staged(part_index(spark, sf_dir), "token-index")
    return search.search_records(queries, index, records, "id")


@query("record_items", """
SELECT 'CUSTOMER#' || c_custkey AS "PK", 'METADATA#latest' AS "SK", c_name, c_mktsegment, '2050-01-01' AS meta_sync_timestamp
FROM customer
""")
def record_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.record_items(
        table(spark, sf_dir, "customer"), F.col("c_custkey"), "CUSTOMER", ["c_name", "c_mktsegment"],
        F.lit("2050-01-01"),
    )


@query("last_write_wins", """
SELECT 'CUSTOMER#' || o_custkey AS "PK", o_orderpriority AS "SK", o_orderkey, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    writes = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CUSTOMER#"), text("o_custkey")).alias("PK"), F.col("o_orderpriority").alias("SK"),
        "o_orderkey", "o_orderstatus", "o_orderdate",
    )
    return items.last_write_wins(writes, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("item_documents", """
SELECT 'O#' || o_orderkey AS "PK", strftime(o_orderdate, '%Y') AS "SK",
  '{"PK":"O#' || o_orderkey || '","SK":"' || strftime(o_orderdate, '%Y') || '"'
  || CASE WHEN o_orderstatus <> 'P' THEN ',"status":"' || o_orderstatus || '"' ELSE '' END
  || ',"ordered":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}' AS document FROM orders
""")
def item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored items: NULL attributes left out, dates as ISO text, kinds replaced one by one."""
    path = scratch_path(spark, "items")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O#"), text("o_orderkey")).alias("PK"), F.date_format("o_orderdate", "yyyy").alias("SK"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_orderdate").cast("date").alias("ordered"),
    )
    stale = rows.withColumn("SK", F.lit("stale"))
    item_sink.write_items(stale, path, "record")
    item_sink.write_items(stale.select("PK", "SK"), path, "search")
    item_sink.write_items(rows, path, "record")
    return item_sink.read_items(spark, path, "record").select("PK", "SK", "document")


@query("write_outcome", """
SELECT count(*) FILTER (o_orderstatus <> 'P') AS written, count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders
""")
def write_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items found in the store against those sent; here a store that lost one status."""
    sent = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O#"), text("o_orderkey")).alias("PK"), F.lit("METADATA#latest").alias("SK"), "o_orderstatus"
    )
    return item_sink.write_outcome(sent, sent.filter("o_orderstatus <> 'P'"), ["PK", "SK"])


@query("version_items", f"""WITH {versions.history_sql(3)}
SELECT 'ITEM#CUSTOMER#' || o_custkey AS "PK",
  CASE WHEN status = 'current' THEN 'V#CURRENT' ELSE 'V#' || active_from END AS "SK", content_hash FROM hist""")
def version_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = versions.versions(spark, sf_dir, [1, 2, 3])
    return items.version_items(done, versions.KEY, "CUSTOMER").select("PK", "SK", "content_hash")


@query("record_refresh", f"""WITH {versions.history_sql(2)},
touched AS (SELECT * FROM hist WHERE run_id = 'run2')
SELECT 'ITEM#CUSTOMER#' || o_custkey AS "PK", 'V#' || active_from AS "SK", false AS is_current, content_hash, active_to
FROM touched WHERE status = 'historical'
UNION ALL
SELECT 'ITEM#CUSTOMER#' || o_custkey, 'V#CURRENT', status = 'current', content_hash, active_to FROM touched
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY active_to DESC) = 1""")
def record_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of new, changed and vanished customers after the second snapshot."""
    changes = v.changes_on(versions.versions(spark, sf_dir, [1, 2]), versions.DAYS[1])
    return iso_dates(items.record_refresh(changes, versions.KEY, "CUSTOMER").select(
        "PK", "SK", "is_current", "content_hash", "active_to"
    ))


@query("current_tokens", f"""WITH {versions.history_sql(3)}
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS entity_id, 'priority' AS field, unnest({tokens_sql('priority')}) AS token
FROM hist WHERE status = 'current'""")
def current_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed versions give no tokens."""
    done = versions.versions(spark, sf_dir, [1, 2, 3])
    return search.token_index(serving.current_only(done), text(versions.KEY), {"priority": "priority"})


REFRESH_SQL = f"""{versions.history_sql(2)},
act AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS entity_id FROM hist WHERE run_id = 'run2'),
old AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS entity_id, unnest({tokens_sql('priority')}) AS token FROM s
  WHERE run = 1 AND CAST(o_custkey AS VARCHAR) IN (SELECT entity_id FROM act)),
new AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS entity_id, unnest({tokens_sql('priority')}) AS token FROM s
  WHERE run = 2 AND CAST(o_custkey AS VARCHAR) IN (SELECT entity_id FROM act))
"""


@query("refresh_plan", f"""WITH {REFRESH_SQL}
SELECT entity_id, 'priority' AS field, token, 'delete' AS operation FROM (SELECT * FROM old EXCEPT SELECT * FROM new)
UNION ALL SELECT entity_id, 'priority', token, 'put' FROM (SELECT * FROM new EXCEPT SELECT * FROM old)""")
def refresh_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = versions.versions(spark, sf_dir, [1])
    second = staged(v.scd2_apply(
        first, versions.snapshot(spark, sf_dir, versions.DAYS[1]), versions.KEY, versions.BUSINESS,
        versions.DAYS[1], "run2",
    ), "versions")
    actions = v.batch_actions(v.changes_on(second, versions.DAYS[1]), versions.KEY)

    def index(df: DataFrame) -> DataFrame:
        return search.token_index(serving.current_only(df), text(versions.KEY), {"priority": "priority"})

    return items.token_refresh(index(first), index(second), actions, versions.KEY)


@query("idempotent_items", """
SELECT 'C#' || c_custkey AS "PK" FROM customer WHERE c_acctbal <= 5000 OR c_mktsegment = 'BUILDING'
""")
def idempotent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items already loaded with the same content in the same batch are skipped."""
    customers = table(spark, sf_dir, "customer")

    def batch(df: DataFrame) -> DataFrame:
        return df.select(
            F.concat(F.lit("C#"), text("c_custkey")).alias("PK"), F.lit("METADATA#latest").alias("SK"),
            F.lit("batch1").alias("batch_id"), fingerprint(df, ["c_name", "c_mktsegment"]).alias("fingerprint"),
        )

    before = customers.filter("c_acctbal > 5000").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "BUILDING", "OTHER").otherwise(F.col("c_mktsegment"))
    )
    return items.not_yet_applied(batch(customers), batch(before)).select("PK")


_GIVEN = ["fda_ndc_11", "fda_proprietary_name", "rxnorm_rxcui", "rxnorm_tty", "rxnorm_str"]
_CODESET_COLUMNS = ", ".join(ds.CODESET_FDA + ds.CODESET_RXNORM)
_ABSENT = ", ".join(
    f"CAST(NULL AS {ds.CODESET_TYPES.get(c, 'varchar')}) AS {c}" for c in ds.CODESET_FDA + ds.CODESET_RXNORM if c not in _GIVEN)
CODESETS_SQL = f"""{concepts.NAMED_SQL},
gold AS (SELECT lpad(CAST(l_partkey AS VARCHAR), 5, '0') || lpad(CAST(l_suppkey AS VARCHAR), 4, '0')
      || CASE l_returnflag WHEN 'R' THEN '02' WHEN 'N' THEN '03' ELSE '01' END AS ndc_11, max(l_linestatus) AS proprietary_name
  FROM lineitem GROUP BY ALL),
prods AS (SELECT id AS rxcui, tty, name AS str FROM base WHERE tty = 'SCD'),
bridge AS (SELECT DISTINCT ndc_11, rxcui FROM named),
codesets AS (SELECT g.ndc_11 AS fda_ndc_11, g.proprietary_name AS fda_proprietary_name,
    p.rxcui AS rxnorm_rxcui, p.tty AS rxnorm_tty, p.str AS rxnorm_str, 'run1' AS meta_run_id, {_ABSENT}
  FROM (SELECT g.*, b.rxcui FROM gold g LEFT JOIN bridge b ON g.ndc_11 = b.ndc_11) g FULL JOIN prods p ON g.rxcui = p.rxcui)
"""


def codesets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of shipments, the mappings that name some of them, and all generic products."""
    code = F.concat(
        F.lpad(text("l_partkey"), 5, "0"), F.lpad(text("l_suppkey"), 4, "0"),
        F.when(F.col("l_returnflag") == "R", "02").when(F.col("l_returnflag") == "N", "03").otherwise("01"),
    )
    codes = table(spark, sf_dir, "lineitem").groupBy(code.alias("ndc_11")).agg(
        F.max("l_linestatus").alias("proprietary_name")
    )
    base = plan.base_products(plan.concept_nodes(concepts.conso(spark, sf_dir)))
    products = staged(base.filter("type = 'SCD'").select(
        F.col("id").alias("rxnorm_rxcui"), F.col("type").alias("rxnorm_tty"), F.col("name").alias("rxnorm_str")
    ), "products")
    mappings = plan.named_mappings(concepts.sat(spark, sf_dir), products)
    return serving.drug_codesets(staged(codes, "codes"), staged(mappings, "mappings"), products, "run1")


@query("codeset_assembly", f"WITH {CODESETS_SQL} SELECT * FROM codesets")
def codeset_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codesets(spark, sf_dir)


_CODESET_FIELDS = {
    "ndc": "fda_ndc_11", "proprietary_name": "fda_proprietary_name", "rxcui": "rxnorm_rxcui", "rxnorm_str": "rxnorm_str",
}


@query("codeset_index", f"WITH {CODESETS_SQL} " + " UNION ".join(
    f"SELECT coalesce(fda_ndc_11, rxnorm_rxcui) AS entity_id, '{label}' AS field, unnest({tokens_sql(column)}) AS token FROM codesets"
    for label, column in _CODESET_FIELDS.items()
))
def codeset_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.codeset_index(codesets(spark, sf_dir))


@query("codeset_records", f"""WITH {CODESETS_SQL}
SELECT 'DRUG#' || coalesce(fda_ndc_11, rxnorm_rxcui) AS "PK", 'METADATA#latest' AS "SK", {_CODESET_COLUMNS},
  meta_run_id, '2050-01-01' AS meta_sync_timestamp
FROM codesets WHERE coalesce(fda_ndc_11, rxnorm_rxcui) IS NOT NULL""")
def codeset_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.codeset_records(codesets(spark, sf_dir), F.lit("2050-01-01"))


@query("codes_with_concepts", f"""WITH {concepts.NAMED_SQL}
SELECT lpad(CAST(p AS VARCHAR), 5, '0') || lpad(CAST(s AS VARCHAR), 4, '0') || '01' AS ndc_11, n.rxcui, n.tty
FROM pair LEFT JOIN (SELECT DISTINCT ndc_11, rxcui, tty FROM named) n
  ON n.ndc_11 = lpad(CAST(p AS VARCHAR), 5, '0') || lpad(CAST(s AS VARCHAR), 4, '0') || '01'""")
def codes_with_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package codes with the concept their mapping names, where there is one."""
    from stratalake.operators import merge

    codes = fda.packages(spark, sf_dir).select(
        F.regexp_replace("product_id", "_.*", "").alias("part"), F.split("ndc_package_code", "-")[1].alias("supplier")
    ).select(F.concat(F.lpad("part", 5, "0"), F.lpad("supplier", 4, "0"), F.lit("01")).alias("ndc_11"))
    named = concepts.named_mappings(spark, sf_dir).select("ndc_11", "rxcui", "tty").distinct()
    return merge.enrich(codes, named, {"ndc_11": "ndc_11"})


@query("product_versions", f"""WITH {concepts.PRODUCTS_SQL}
SELECT rxnorm_rxcui AS rxcui, rxnorm_tty AS tty, rxnorm_ingredient_names AS ingredient_names,
  md5(concat_ws('|', rxnorm_tty, coalesce(rxnorm_str, ''), coalesce(rxnorm_strength, ''), coalesce(rxnorm_ingredient_names, ''),
    coalesce(rxnorm_brand_names, ''), coalesce(rxnorm_dosage_forms, ''), coalesce(rxnorm_psn, ''), coalesce(rxnorm_sbdf_rxcui, ''),
    coalesce(rxnorm_sbdf_name, ''), coalesce(rxnorm_scdf_rxcui, ''), coalesce(rxnorm_scdf_name, ''), coalesce(rxnorm_sbd_rxcui, ''),
    coalesce(rxnorm_bpck_rxcui, ''), CAST(rxnorm_multi_ingredient AS VARCHAR))) AS content_hash,
  '2050-01-01' AS active_from, 'current' AS status, 'silver.rxnorm_products' AS source_file
FROM wide""")
def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide products versioned for the first time."""
    rows = plan.product_snapshot(concepts.products(spark, sf_dir), "rxnorm_products")
    done = v.scd2_apply(None, rows, ds.PRODUCTS_KEY, ds.PRODUCTS_BUSINESS, "2050-01-01", "run1")
    return iso_dates(done.select(
        "rxcui", "tty", "ingredient_names", "content_hash", "active_from", "status", "source_file"
    ))


@query("products_by_ingredient", f"""WITH {concepts.PRODUCTS_SQL}
SELECT rxnorm_rxcui AS rxcui, rxnorm_str AS str, rxnorm_ingredient_names AS ingredient_names, rxnorm_brand_names AS brand_names
FROM wide WHERE lower(rxnorm_ingredient_names) LIKE '%brand#7%'""")
def products_by_ingredient(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratalake.plans import reports

    rows = plan.product_snapshot(concepts.products(spark, sf_dir), "rxnorm_products")
    return reports.by_ingredient(rows.withColumn("status", F.lit("current")), "Brand#7")


@query("multi_ingredient_products", f"""WITH {concepts.PRODUCTS_SQL}
SELECT rxnorm_rxcui AS rxcui, rxnorm_str AS str, rxnorm_ingredient_names AS ingredient_names, rxnorm_strength AS strength
FROM wide WHERE rxnorm_multi_ingredient""")
def multi_ingredient_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratalake.plans import reports

    rows = plan.product_snapshot(concepts.products(spark, sf_dir), "rxnorm_products")
    return reports.multi_ingredient(rows.withColumn("status", F.lit("current")))
