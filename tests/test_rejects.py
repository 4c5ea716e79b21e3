"""Records that cannot be read are counted, kept and named; whole documents come back as they were."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.plans import daily, monthly
from stratalake.plans import datasets as ds
from stratalake.plans.together import run_together
from stratalake.session import staged
from stratalake.sinks import tables
from stratalake.sinks.versioned import VersionedTable
from stratalake.sources import documents, files
from tests.conftest import rows
from tests.test_flows import drop_fda, lay_out


def test_delimited_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v,w\n1,one,x\n2,two\n3,"three, quoted",y\n4,four,z,more\n,,\n')
    good, bad = files.split_malformed(staged(files.read_delimited_checked(spark, str(tmp_path / "a.csv")), "t"))
    assert rows(good) == [("1", "one", "x"), ("3", "three, quoted", "y"), (None, None, None)]
    got = bad.orderBy("record").collect()
    assert [r.record for r in got] == ["2,two", "4,four,z,more"]
    assert {r.source_file.rsplit("/", 1)[1] for r in got} == {"a.csv"} and {r.reason for r in got} == {"malformed record"}


def test_json_rejects(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"rxclassMinConceptList": {"rxclassMinConcept": [{"classId": "1"}]}}, indent=2))
    (tmp_path / "bad.json").write_text('{"rxclassMinConceptList": ')
    checked = staged(documents.read_checked_documents(spark, str(tmp_path), documents.CLASS_LIST_SCHEMA), "t")
    good, bad = files.split_malformed(checked)
    assert documents.class_rows(good, "r").count() == 1
    assert [r.source_file.rsplit("/", 1)[1] for r in bad.collect()] == ["bad.json"]


def test_class_list_with_an_unreadable_part_fails(spark, tmp_path):
    layout = lay_out(tmp_path)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"rxclassMinConceptList": {"rxclassMinConcept": [
        {"classId": "1", "className": "n", "classType": "t"}]}}))
    assert monthly.load_classes(spark, layout, str(tmp_path / "in"), "r", min_rows=1).count() == 1
    (tmp_path / "in" / "b.json").write_text("[1, ")
    with pytest.raises(quality.QualityError, match="b.json"):
        monthly.load_classes(spark, layout, str(tmp_path / "in"), "r", min_rows=1)


def test_responses(spark):
    given = [("1", "{}"), ("2", "not json"), ("3", None), ("4", '{"rxclassDrugInfoList": {}}'), ("5", " "), ("6", '{"rxclassDrugInfoList"')]
    readable, unreadable = documents.split_responses(spark.createDataFrame(
        [(p, "SCD", b) for p, b in given], "product_rxcui string, product_tty string, body string"))
    assert [r[0] for r in rows(readable)] == ["1", "4"]
    assert [(r[0], r[3]) for r in rows(unreadable)] == [
        ("2", "malformed body"), ("3", "no body"), ("5", "no body"), ("6", "malformed body")]


def test_unreadable_answers_expire_nothing(spark, tmp_path):
    schema = "rxcui string, class_id string, v string"
    table = VersionedTable(spark, str(tmp_path / "t"), ["rxcui", "class_id"], ["v"])
    first = spark.createDataFrame([("1", "a", "x"), ("1", "b", "x"), ("2", "a", "x"), ("3", "a", "x")], schema)
    daily.apply_snapshot(table, first, str(tmp_path / "rejects"), "2050-01-01", "r1")
    second = spark.createDataFrame([("1", "a", "x")], schema)
    silent = spark.createDataFrame([("2",), ("2",)], "rxcui string")
    done = daily.apply_snapshot(table, second, str(tmp_path / "rejects"), "2050-01-02", "r2", unheard=silent)
    assert done["expired"] == 2
    assert rows(table.read().filter("status = 'current'").select("rxcui", "class_id")) == [("1", "a"), ("2", "a")]


PACKAGES = "0001-1_aaa\t0001-11-1\tbox\t20190101\t\n0002-2_bbb\t0002-22-2\tbox\t\t\nbroken line\n0003-3_ccc\t0003-33-3\tjar\t\t\n"


def test_strict_daily_flow_keeps_rejects(spark, tmp_path):
    layout = lay_out(tmp_path)
    drop_fda(tmp_path / "raw" / "run_id=r1", PACKAGES)
    done = daily.run_daily(spark, layout, "r1", "2050-01-01", strict=True)
    assert (done["new"], done["malformed"]) == (3, 1)
    kept = spark.read.parquet(f"{layout.bronze}/rejects/fda-cder").first()
    assert (kept.record, kept.target_table, kept.reject_run_id) == ("broken line", "fda-packages", "r1")


def test_daily_flow_from_the_catalog(spark, tmp_path):
    layout = lay_out(tmp_path)
    drop_fda(tmp_path / "raw" / "run_id=r1", PACKAGES.replace("broken line\n", ""))
    daily.run_daily(spark, layout, "r1", "2050-01-01")
    names = {}
    for table in daily.REQUIRED:
        dataset = "fda-nsde" if table == "fda-nsde" else f"fda-cder/{table}"
        names[table] = table.replace("-", "_") + "_bronze"
        spark.read.parquet(f"{layout.bronze}/{dataset}").createOrReplaceTempView(names[table])
    other = lay_out(tmp_path / "other")
    assert daily.run_daily(spark, other, "r2", "2050-01-01", catalog=names)["new"] == 3
    spark.table("fda_products_bronze").drop("dea_schedule").createOrReplaceTempView("fda_products_bronze")
    with pytest.raises(quality.QualityError) as error:
        daily.run_daily(spark, other, "r3", "2050-01-02", catalog={**names, "fda-nsde": "nowhere"})
    assert "no table nowhere" in str(error.value) and "no column dea_schedule in fda_products_bronze" in str(error.value)


def test_whole_documents(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    texts = {"a.json": b'{\n  "a": 1\r\n}\n', "b.json": b"", "deep/c.json": "Ünï\n".encode() * 5000}
    for name, content in texts.items():
        (tmp_path / "in" / name).write_bytes(content)
    for _ in range(2):
        tables.keep_documents(documents.read_raw_documents(spark, str(tmp_path / "in")), str(tmp_path / "kept"), "r1")
    kept = spark.read.parquet(str(tmp_path / "kept"))
    got = {r.path.split("/in/")[1]: (bytes(r.content), r.length, r.digest) for r in kept.collect()}
    assert got == {n: (c, len(c), hashlib.sha256(c).hexdigest()) for n, c in texts.items() if c}
    assert documents.damaged_documents(kept).isEmpty()
    assert documents.damaged_documents(kept.withColumn("content", F.expr("substring(content, 2)"))).count() == 2
    with pytest.raises(Exception, match="line breaks"):
        tables.keep_raw_text(spark.createDataFrame([("a\nb",)], "v string"), "v", str(tmp_path / "raw"), "r")


def test_sample_per_reason_is_the_same_however_dealt(spark):
    rejects = spark.range(3000).selectExpr("id", "case when id % 10 = 0 then 'rare' when id = 7 then null else 'hot' end as reason")
    one = rows(quality.sample_per_reason(rejects.coalesce(1), "reason", 5))
    many = rows(quality.sample_per_reason(rejects.repartition(17), "reason", 5))
    assert one == many and len(one) == 11
    plan = quality.sample_per_reason(rejects, "reason", 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_steps_run_together_and_fail_as_one(spark):
    done = run_together(spark, {"b": lambda: spark.range(5).count(), "a": lambda: spark.range(7).count()})
    assert list(done.items()) == [("b", 5), ("a", 7)]

    def broken():
        raise ValueError("no drop")

    with pytest.raises(ValueError, match="no drop"):
        run_together(spark, {"x": lambda: spark.range(10).count(), "y": broken, "z": lambda: spark.range(10).count()}, at_once=1)


def test_newest_run_opens_no_other(spark, tmp_path):
    spark.range(6).selectExpr("id as value", "concat('2024010', id % 3, '_000000') as run_id").write.partitionBy("run_id").parquet(str(tmp_path / "raw"))
    newest = files.latest_run(files.read_runs(spark, str(tmp_path / "raw"), "value bigint, run_id string"))
    assert rows(newest.select("value")) == [(2,), (5,)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "Join" not in plan
    nothing = files.latest_run(spark.createDataFrame([], "value bigint, run_id string"))
    assert nothing.isEmpty()


def test_earlier_run_dates_are_refused(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k", ["v"])
    df = spark.createDataFrame([("a", "1")], "k string, v string")
    table.apply(df, "2050-01-02", "r1")
    with pytest.raises(ValueError, match="after one of 2050-01-02"):
        table.apply(df.withColumn("v", F.lit("2")), "2050-01-01", "r2")
    assert table.apply(df.withColumn("v", F.lit("2")), "2050-01-02", "r3")["changed"] == 1
