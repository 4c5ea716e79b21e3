"""Search, items, sinks and the serving flow."""

import json
import random

import pytest
from pyspark.sql import functions as F

from stratalake.functions.text import STOP_WORDS
from stratalake.operators import items, quality, search
from stratalake.plans import datasets as ds
from stratalake.plans import serving, sync
from stratalake.sinks import items as sink
from stratalake.sinks import tables
from tests.conftest import rows

WORDS = ["tablet", "oral", "red", "blue", "mint", "the", "mg", "500", "kit"]


def brute_tokens(text):
    return {w for w in (text or "").lower().replace("/", " ").replace("|", " ").split()
            if len(w) >= 3 and w not in STOP_WORDS}


@pytest.mark.parametrize("match_all", [True, False])
@pytest.mark.parametrize("rows_per_task", [3, 10**6])
def test_search_against_brute_force(spark, match_all, rows_per_task):
    chance = random.Random(5)
    texts = [(i, "/".join(chance.sample(WORDS, chance.randint(0, 5)))) for i in range(60)]
    # "tablet" is in almost every text, so its entries are a hot group.
    texts = [(i, t + "|tablet") if i % 10 else (i, t) for i, t in texts]
    asked = [(j, " ".join(chance.sample(WORDS, chance.randint(0, 3)))) for j in range(12)] + [(99, "tablet nowhere")]
    index = search.token_index(spark.createDataFrame(texts, "id int, t string"), F.col("id"), {"t": "t"})
    got = search.search(
        spark.createDataFrame(asked, "query_id int, query string"), index, match_all, rows_per_task
    )
    want = []
    for j, q in asked:
        for i, t in texts:
            both = brute_tokens(q) & brute_tokens(t)
            if both and (not match_all or both == brute_tokens(q)):
                want.append((j, i, len(both)))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_last_write_wins(spark):
    df = spark.createDataFrame([("p", "s", 1, "a"), ("p", "s", 3, None), ("p", "s", 2, "c"), ("p", "t", 1, "d")],
                               "PK string, SK string, at int, v string")
    assert rows(items.last_write_wins(df, ["at"])) == [("p", "s", 3, None), ("p", "t", 1, "d")]


def test_item_documents_drop_nulls(spark, tmp_path):
    df = spark.createDataFrame([("p", "s", None, 1)], "PK string, SK string, gone string, n int").withColumn(
        "d", F.lit("2020-01-02").cast("date"))
    path = str(tmp_path / "items")
    sink.write_items(df, path, "record", expected=1)
    stored = sink.read_items(spark, path, "record").first()
    assert json.loads(stored.document) == {"PK": "p", "SK": "s", "n": 1, "d": "2020-01-02"}


def test_items_of_a_kind_are_replaced(spark, tmp_path):
    path = str(tmp_path / "items")
    df = spark.range(20).select(F.lit("SEARCH#X").alias("PK"), F.col("id").cast("string").alias("SK"))
    sink.write_items(df, path, "search", expected=20)
    sink.write_items(df, path, "record")
    sink.write_items(df.filter("SK < '2'"), path, "search")
    assert sink.read_items(spark, path, "record").count() == 20
    assert sink.read_items(spark, path, "search").count() == 12
    outcome = sink.write_outcome(df, sink.read_items(spark, path, "search")).first()
    assert (outcome.written, outcome.failed) == (12, 8)


def test_failure_gate():
    sink.gate_failures(0, 1000, 10)
    for lost in ((1, 1000, 0), (0, 1000, 11)):
        with pytest.raises(quality.QualityError):
            sink.gate_failures(*lost)
    assert [items.item_partitions(n) for n in (0, 19_999, 25_000)] == [4, 4, 5]


def test_record_refresh_closes_current_items(spark):
    days = "cast(active_from as date) active_from, cast(active_to as date) active_to"
    changes = spark.createDataFrame([
        (1, "new", "2020-01-05", "9999-12-31", "current", "v1"),
        (2, "old", "2020-01-01", "2020-01-05", "historical", "v2"),
        (2, "now", "2020-01-05", "9999-12-31", "current", "v3"),
        (3, "gone", "2020-01-02", "2020-01-05", "historical", "v4"),
        (4, "brief", "2020-01-05", "2020-01-05", "historical", "v5"),
        (4, "later", "2020-01-05", "9999-12-31", "current", "v6"),
    ], "k int, v string, active_from string, active_to string, status string, version_id string",
    ).selectExpr("k", "v", days.split(", ")[0], days.split(", ")[1], "status", "version_id")
    got = rows(items.record_refresh(changes, "k", "X").select("PK", "SK", "is_current", "v"))
    assert got == sorted([
        ("ITEM#X#1", "V#CURRENT", True, "new"),
        ("ITEM#X#2", "V#2020-01-01", False, "old"), ("ITEM#X#2", "V#CURRENT", True, "now"),
        ("ITEM#X#3", "V#2020-01-02", False, "gone"), ("ITEM#X#3", "V#CURRENT", False, "gone"),
        ("ITEM#X#4", "V#2020-01-05#v5", False, "brief"), ("ITEM#X#4", "V#CURRENT", True, "later"),
    ])
    stored = items.version_items(changes, "k", "X")
    assert stored.select("PK", "SK").distinct().count() == stored.filter("k <> 3").count() + 1


def test_token_refresh(spark):
    schema = "entity_id string, field string, token string"
    before = spark.createDataFrame([("1", "n", "old"), ("1", "n", "kept"), ("2", "n", "gone"), ("9", "n", "still")], schema)
    after = spark.createDataFrame([("1", "n", "kept"), ("1", "n", "new"), ("3", "n", "fresh")], schema)
    actions = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(items.token_refresh(before, after, actions, "k")) == [
        ("1", "n", "new", "put"), ("1", "n", "old", "delete"), ("2", "n", "gone", "delete"), ("3", "n", "fresh", "put"),
    ]


def codesets(spark):
    codes = spark.createDataFrame(
        [("00000000001", "Brand one"), ("00000000002", "Brand two"), (None, "no code")],
        "ndc_11 string, proprietary_name string")
    mappings = spark.createDataFrame([("00000000001", "r1")], "ndc_11 string, rxcui string")
    products = spark.createDataFrame([("r1", "SCD", "Drug / 500 mg"), ("r2", "SCD", "other drug")],
                                     "rxnorm_rxcui string, rxnorm_tty string, rxnorm_str string")
    return serving.drug_codesets(codes, mappings, products, "run1")


def test_codesets_keep_both_sides(spark):
    got = rows(codesets(spark).select("fda_ndc_11", "fda_proprietary_name", "rxnorm_rxcui"))
    assert got == [
        ("00000000001", "Brand one", "r1"), ("00000000002", "Brand two", None), (None, "no code", None), (None, None, "r2"),
    ]


def test_sync(spark, tmp_path):
    path = str(tmp_path / "store")
    summary = sync.run_sync(spark, codesets(spark), path, "run1")
    keys = {r.SK for r in sink.read_items(spark, path, "search").collect()}
    assert summary == {"run_id": "run1", "record_written": 3, "search_written": len(keys)}
    assert "token#drug#rxnorm_str#DRUG#00000000001" in keys and "token#500#rxnorm_str#DRUG#00000000001" in keys
    assert "token#00000000002#ndc#DRUG#00000000002" in keys
    record = {r.PK: json.loads(r.document) for r in sink.read_items(spark, path, "record").collect()}
    assert set(record) == {"DRUG#00000000001", "DRUG#00000000002", "DRUG#r2"}
    assert "fda_ndc_11" not in record["DRUG#r2"] and "meta_sync_timestamp" in record["DRUG#r2"]
    again = sync.run_sync(spark, codesets(spark).filter("fda_ndc_11 is not null"), path, "run2")
    assert again["record_written"] == 2 == sink.read_items(spark, path, "record").count()


def test_record_columns_are_known():
    assert len(ds.CODESET_FDA) == 16 and len(ds.CODESET_RXNORM) == 15


def test_partitioned_overwrite_is_complete(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("current", 1), ("historical", 2)], "status string, n int")
    tables.overwrite(df, path, partition_by="status")
    tables.overwrite(df.filter("n = 1"), path, partition_by="status")
    assert spark.read.parquet(path).count() == 1
    tables.append_batch(df, str(tmp_path / "b"), "x")
    tables.append_batch(df, str(tmp_path / "b"), "x")
    tables.append_batch(df, str(tmp_path / "b"), "y")
    assert spark.read.parquet(str(tmp_path / "b")).count() == 4


def test_members_of_a_common_class_are_dealt_by_product(spark):
    from stratalake.plans import reports

    columns = ["class_id", "class_name", "rxcui", "tty", "rela", "relasource"]
    members = spark.range(400).selectExpr(
        "if(id % 4 = 0, null, 'c' || id % 2) class_id", "'n' class_name", "if(id % 7 = 0, null, cast(id % 90 as string)) rxcui",
        "'SCD' tty", "'r' rela", "'s' relasource")
    classes = spark.createDataFrame([("c1",), ("c1",), (None,), ("c9",)], "class_id string")
    got = reports.lookup_products(members, classes)
    assert rows(got) == rows(members.filter("class_id = 'c1'").select(*columns).distinct())
    assert "_share" in got._jdf.queryExecution().optimizedPlan().toString()
