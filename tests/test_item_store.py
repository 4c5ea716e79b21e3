"""Batches of the item store: order, replay, recovery, and what is rewritten."""

import json

import pytest
from pyspark.sql import functions as F

from stratalake.operators import items
from stratalake.plans import sync
from stratalake.sinks import items as sink
from stratalake.sinks.item_store import ItemStore
from tests.conftest import rows

OPERATION = "PK string, SK string, operation string, document string, at int"


def batch(spark, *writes):
    return spark.createDataFrame([(*w, 0)[:5] for w in writes], OPERATION)


def held(store):
    return {(r.PK, r.SK): r.document for r in store.items().collect()}


@pytest.fixture
def store(spark, tmp_path):
    return ItemStore(spark, str(tmp_path / "store"), 8)


def test_puts_and_deletes(spark, store):
    first = store.apply(batch(spark, ("p", "a", "put", "1"), ("p", "b", "put", "2"), ("q", "a", "delete", None)), "b1", "1")
    assert (first["pending"], first["changed"]) == (3, 3)
    second = store.apply(batch(spark, ("p", "a", "delete", None), ("p", "c", "put", "3")), "b2", "2")
    assert held(store) == {("p", "b"): "2", ("p", "c"): "3"}
    assert second["changed"] == 2 and second["buckets"] <= 2


def test_a_batch_twice_writes_nothing(spark, store, tmp_path):
    writes = batch(spark, *[("p", str(i), "put", str(i)) for i in range(40)])
    store.apply(writes, "b1", "1")
    before = sorted(str(p) for p in tmp_path.rglob("*.parquet"))
    again = store.apply(writes, "b1", "1")
    assert (again["pending"], again["changed"], again["buckets"], again["rewritten"]) == (0, 0, 0, 0)
    assert sorted(str(p) for p in tmp_path.rglob("*.parquet")) == before


def test_a_batch_that_died_is_completed(spark, store, tmp_path):
    writes = batch(spark, *[("p", str(i), "put", str(i)) for i in range(60)])
    store.apply(batch(spark, ("p", "3", "put", "old"), ("p", "x", "put", "kept")), "b0", "0")
    # As if the job had ended after some buckets, before the ledger.
    changes = writes.select(*items.ITEM_KEY, "document", store.bucket_of().alias("bucket"),
                            F.lit("1").alias("batch_order"), F.lit("b1").alias("batch_id")).filter("bucket < 4")
    store.rewrite(changes, [0, 1, 2, 3])
    finished = {str(p) for p in tmp_path.rglob("*.parquet") if any(f"bucket={b}" in str(p.parent) for b in range(4))}
    done = store.apply(writes, "b1", "1")
    assert done["pending"] == 60 and done["changed"] == 60 - changes.count()
    assert held(store) == {("p", "x"): "kept", **{("p", str(i)): str(i) for i in range(60)}}
    assert finished == {str(p) for p in tmp_path.rglob("*.parquet") if any(f"bucket={b}" in str(p.parent) for b in range(4))}
    assert store.apply(writes, "b1", "1")["pending"] == 0


def test_late_batches_do_not_win(spark, store):
    store.apply(batch(spark, ("p", "a", "put", "new"), ("p", "b", "delete", None)), "b2", "2")
    late = store.apply(batch(spark, ("p", "a", "put", "old"), ("p", "b", "put", "old"), ("p", "c", "put", "old")), "b1", "1")
    assert (late["pending"], late["changed"]) == (3, 1)
    assert held(store) == {("p", "a"): "new", ("p", "c"): "old"}


def test_only_touched_buckets_are_rewritten(spark, store, tmp_path):
    store.apply(batch(spark, *[("p", str(i), "put", str(i)) for i in range(100)]), "b1", "1")
    before = {str(p) for p in (tmp_path / "store" / "items").rglob("*.parquet")}
    done = store.apply(batch(spark, ("p", "7", "put", "seven")), "b2", "2")
    after = {str(p) for p in (tmp_path / "store" / "items").rglob("*.parquet")}
    assert done["buckets"] == 1 and len(before - after) == 1 and 0 < done["rewritten"] < 100
    assert held(store)[("p", "7")] == "seven" and len(held(store)) == 100


def test_keys_of_a_null_are_never_held(spark, store):
    writes = batch(spark, ("p", None, "put", "1"), ("p", "a", "put", "2"))
    done = [store.apply(writes, "b1", "1") for _ in range(2)]
    assert [(d["pending"], d["changed"]) for d in done] == [(2, 2), (1, 1)]


def test_only_repeated_writes_are_gathered(spark, store, monkeypatch):
    gathered = []
    once = items.single_write

    def counted(df, *rest):
        gathered.append(df.count())
        return once(df, *rest)

    monkeypatch.setattr(items, "single_write", counted)
    writes = batch(spark, *[("p", str(i), "put", str(i)) for i in range(50)])
    store.apply(writes, "b1", "1")
    assert gathered == []
    store.apply(writes.unionByName(batch(spark, ("p", "x", "put", "1"), ("p", "x", "put", "1"))), "b2", "2")
    assert gathered == [2]
    assert held(store) == {("p", "x"): "1", **{("p", str(i)): str(i) for i in range(50)}}


def test_items_are_made_of_changed_entities_alone(spark, monkeypatch):
    schema = "fda_ndc_11 string, fda_proprietary_name string, rxnorm_rxcui string, rxnorm_str string"
    same = [(str(i), f"Name{i} word", None, None) for i in range(40)]
    before = spark.createDataFrame([*same, ("x", "Alpha", None, None), ("y", "Gone", "r1", None), ("y", "Gone", "r2", None)], schema)
    after = spark.createDataFrame([*same, ("x", "Beta", None, None), ("y", "Gone", "r2", None)], schema)
    seen = []
    index = sync.serving.codeset_index

    def indexed(codesets):
        seen.append(sorted(r.fda_ndc_11 for r in codesets.collect()))
        return index(codesets)

    monkeypatch.setattr(sync.serving, "codeset_index", indexed)
    got = {(pk, sk): op for pk, sk, op, _ in rows(sync.codeset_changes(before, after, "b2"))}
    assert got == {
        ("DRUG#x", "METADATA#latest"): "put", ("SEARCH#DRUG", "token#alpha#proprietary_name#DRUG#x"): "delete",
        ("SEARCH#DRUG", "token#beta#proprietary_name#DRUG#x"): "put"}
    assert seen == [["x", "y", "y"], ["x", "y"]]


def test_a_field_of_one_side_touches_nothing_by_itself(spark):
    before = spark.createDataFrame([("1", "Alpha", "brand", "old"), ("2", "Beta", "brand", "same"), ("3", "Same", "brand", "same")],
                                   "fda_ndc_11 string, fda_proprietary_name string, rxnorm_brand_names string, fda_dosage_form string")
    before = before.withColumn("rxnorm_rxcui", F.lit(None).cast("string"))
    after = spark.createDataFrame([("1", "Alpha", "new"), ("2", "Gamma", "same"), ("3", "Same", "same")],
                                  "fda_ndc_11 string, fda_proprietary_name string, fda_dosage_form string")
    after = after.withColumn("rxnorm_rxcui", F.lit(None).cast("string"))
    got = {(pk, sk): op for pk, sk, op, _ in rows(sync.codeset_changes(before, after, "b2"))}
    assert got == {
        ("DRUG#1", "METADATA#latest"): "put", ("DRUG#2", "METADATA#latest"): "put",
        ("SEARCH#DRUG", "token#beta#proprietary_name#DRUG#2"): "delete", ("SEARCH#DRUG", "token#gamma#proprietary_name#DRUG#2"): "put",
        ("SEARCH#DRUG", "token#brand#brand#DRUG#2"): "delete"}


def test_order_within_a_batch(spark, store):
    writes = batch(spark, ("p", "a", "put", "zzz old", 1), ("p", "a", "put", "aaa new", 2))
    store.apply(writes, "b1", "1", order=["at"])
    assert held(store) == {("p", "a"): "aaa new"}
    with pytest.raises(Exception, match="several writes without an order under p a"):
        store.apply(writes, "b2", "2")


def test_the_number_of_buckets_stays(spark, store, tmp_path):
    assert ItemStore(spark, str(tmp_path / "store"), 8).items().count() == 0
    with pytest.raises(ValueError, match="has 8 buckets"):
        ItemStore(spark, str(tmp_path / "store"), 9)


def test_written_items_need_an_order(spark, tmp_path):
    path = str(tmp_path / "items")
    df = spark.createDataFrame([("p", "s", "zzz old", 1), ("p", "s", "aaa new", 2), ("q", "s", "one", 1)], "PK string, SK string, v string, at int")
    sink.write_items(df, path, "record", order=["at"])
    assert {r.PK: json.loads(r.document)["v"] for r in sink.read_items(spark, path).collect()} == {"p": "aaa new", "q": "one"}
    with pytest.raises(Exception, match="several writes"):
        sink.write_items(df, path, "record")
    sink.write_items(df.filter("at = 1").unionByName(df.filter("at = 1")), path, "record")
    assert sink.read_items(spark, path).count() == 2


def test_changes_tell_null_from_empty(spark):
    schema = "PK string, SK string, v string, loaded string"
    before = spark.createDataFrame([("p", "s", None, "1"), ("q", "s", "x", "1"), ("r", "s", "y", "1")], schema)
    after = spark.createDataFrame([("p", "s", "", "2"), ("q", "s", "x", "2"), ("t", "s", None, "2")], schema)
    got = rows(items.record_changes(before, after, ["loaded"]))
    assert [(pk, op) for pk, _, op, _ in got] == [("p", "put"), ("r", "delete"), ("t", "put")]
    assert json.loads(got[0][3]) == {"PK": "p", "SK": "s", "v": "", "loaded": "2"}


def test_sync_batch_equals_a_refill(spark, tmp_path):
    schema = "fda_ndc_11 string, fda_proprietary_name string, rxnorm_rxcui string, rxnorm_str string"
    before = spark.createDataFrame([
        ("1", "Alpha beta", "r1", "drug one"), ("1", "Alpha beta", "r2", "drug two"), ("2", "Gamma", None, None),
        (None, None, "r9", "only product"), ("3", "Same", None, None)], schema)
    after = spark.createDataFrame([
        ("1", "Alpha delta", "r1", "drug one"), ("2", "Gamma", "r3", "drug three"), ("3", "Same", None, None),
        ("4", None, None, None)], schema)
    store = ItemStore(spark, str(tmp_path / "a"), 4)
    sync.run_sync_batch(store, before.limit(0), before, "b1", "1")
    done = sync.run_sync_batch(store, before, after, "b2", "2")
    other = ItemStore(spark, str(tmp_path / "b"), 4)
    sync.run_sync_batch(other, before.limit(0), after, "b1", "1")

    def plain(s):
        return {k: {n: v for n, v in json.loads(d).items() if n != "meta_sync_timestamp"} for k, d in held(s).items()}

    assert plain(store) == plain(other)
    assert ("DRUG#r9", "METADATA#latest") not in held(store)
    assert json.loads(held(store)["DRUG#3", "METADATA#latest"])["meta_sync_timestamp"] == "b1"
    assert done["changed"] == done["pending"] > 0
