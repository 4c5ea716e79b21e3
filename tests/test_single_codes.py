"""Repeated keys are found by their keys alone, and are not multiplied to be rejected."""

from stratalake.operators import merge, skew
from stratalake.operators import versioning as v
from stratalake.sinks.versioned import VersionedTable
from tests.conftest import rows


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sources(spark):
    left = [("a", "la"), ("b", "lb"), (None, "ln")] + [("many", f"l{i}") for i in range(40)] + [("twice", "x")]
    right = [("a", "ra"), ("c", "rc"), (None, "rn")] + [("many", f"r{i}") for i in range(50)] + [("twice", "y")] * 2
    return spark.createDataFrame(left, "k string, t string"), spark.createDataFrame(right, "k string, t string")


def test_single_merge_is_the_merge_without_repeated_keys(spark):
    left, right = sources(spark)
    whole = rows(merge.full_outer_merge(left, right, "k", text=["t"], flag="f"))
    assert len(whole) == 40 * 50 + 7
    for rows_per_task in (10, 1000):
        got = merge.full_outer_merge(left, right, "k", text=["t"], flag="f", rows_per_task=rows_per_task, single=True)
        assert rows(got) == [r for r in whole if r[0] not in ("many", "twice")]


def test_hot_keys_among_many_under_one_hash(spark, monkeypatch):
    monkeypatch.setattr(skew, "HASHES", 2)
    left = spark.range(3000).selectExpr("if(id < 500, -1, id) k", "id a")
    right = spark.range(1000).selectExpr("id k", "id b")
    assert rows(skew.hot_keys(left, right, ["k"], 400)) == [(-1, 500, 0)]


def test_bad_keys_are_split_without_a_shuffle_of_rows(spark, tmp_path):
    made = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n"), (3, None)], "k int, a string")
    made.write.parquet(str(tmp_path / "rows"))
    usable, rejected = v.split_bad_keys(spark.read.parquet(str(tmp_path / "rows")), "k")
    assert rows(usable) == [(1, "x"), (3, None)]
    assert rows(rejected) == [(2, "y"), (2, "z"), (None, "n")]
    assert "Exchange hashpartitioning" not in physical(usable) + physical(rejected)


def test_a_table_of_one_load_is_read_without_a_join(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k", ["a"])
    table.apply(spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string"), "2050-01-01", "r1")
    assert "Join" not in physical(table.read())
    table.apply(spark.createDataFrame([(1, "x"), (2, "z")], "k int, a string"), "2050-01-02", "r2")
    found = rows(table.read().selectExpr("k", "a", "status"))
    assert found == [(1, "x", "current"), (2, "y", "historical"), (2, "z", "current")]
