"""Golden scenarios, properties and refusals of the versioned table."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import integrity
from stratalake.operators import versioning as v
from stratalake.sinks.versioned import VersionedTable
from tests.conftest import rows

SCHEMA = "ndc_11 string, proprietary_name string, strength string, source_run_id string"


def canaries(spark, keys, modified=(), run="s1"):
    made = [
        (f"99999{1000 + i:06d}", f"TEST_PRODUCT_{i + 1}" + ("_MODIFIED" if i in modified else ""),
         "200MG" if i in modified else "100MG", run)
        for i in keys
    ]
    return spark.createDataFrame(made, SCHEMA)


def apply(spark, existing, snapshot, day, run, business=("proprietary_name", "strength")):
    done = v.scd2_apply(existing, snapshot, "ndc_11", list(business), day, run)
    return spark.createDataFrame(done.collect(), done.schema)


def counts(df):
    found = {r.status: r["count"] for r in df.groupBy("status").count().collect()}
    return found.get("current", 0), found.get("historical", 0)


def assert_sound(df, gaps_allowed=False):
    assert integrity.duplicate_current(df, "ndc_11").isEmpty()
    assert integrity.status_mismatches(df).isEmpty()
    faults = {r.fault for r in integrity.interval_faults(df, "ndc_11").collect()}
    assert not faults or (gaps_allowed and faults == {"GAP"})


def test_add_update_term(spark):
    added = apply(spark, None, canaries(spark, range(10)), "2050-01-01", "r1")
    assert counts(added) == (10, 0)
    assert added.select("active_to").distinct().first()[0] == datetime.date(9999, 12, 31)
    assert_sound(added)

    updated = apply(spark, added, canaries(spark, range(10), range(5), "s2"), "2050-01-02", "r2")
    assert counts(updated) == (10, 5)
    closed = updated.filter("status = 'historical'")
    assert rows(closed.select("active_to", "run_date", "run_id").distinct()) == [
        (datetime.date(2050, 1, 2), "2050-01-02", "r2")
    ]
    assert_sound(updated)
    # An unchanged row keeps what it was stored with, also its lineage.
    same = updated.filter("ndc_11 = '99999001007'").first()
    assert (same.run_id, same.source_run_id) == ("r1", "s1")

    ended = apply(spark, updated, canaries(spark, range(3, 10), (3, 4), "s3"), "2050-01-03", "r3")
    assert counts(ended) == (7, 8)
    assert_sound(ended)
    assert v.discontinued(ended, "2050-01-20", 30).count() == 8
    actions = v.batch_actions(v.changes_on(updated, "2050-01-02"), "ndc_11")
    assert rows(actions.groupBy("action").count()) == [("UPDATE", 5)]
    actions = v.batch_actions(v.changes_on(ended, "2050-01-03"), "ndc_11")
    assert rows(actions.groupBy("action").count()) == [("DELETE", 3)]


@pytest.mark.parametrize("buckets", [None, 4])
def test_four_runs_on_one_date(spark, tmp_path, buckets):
    n, day = 40, "2025-10-21"
    first = canaries(spark, range(n))
    second = canaries(spark, range(n + 5), range(10))
    third = second.filter(F.col("ndc_11") >= "99999001005")
    table = VersionedTable(
        spark, str(tmp_path / "t"), "ndc_11", ["proprietary_name", "strength"], buckets,
        "four_runs" if buckets else None,
    )
    outcomes, sizes = [], []
    for number, snapshot in enumerate([first, second, third, second], 1):
        outcomes.append(table.apply(snapshot, day, f"r{number}"))
        sizes.append(counts(table.read()))
    picked = [(o["new"], o["changed"], o["expired"]) for o in outcomes]
    assert picked == [(n, 0, 0), (5, 10, 0), (0, 0, 5), (5, 0, 0)]
    assert sizes == [(n, 0), (n + 5, 10), (n, 15), (n + 5, 15)]
    assert outcomes[1]["total_written"] == 25
    assert table.apply(second, day, "r5")["version"] is None
    assert counts(table.read(2)) == (n + 5, 10)
    assert rows(table.read(1)) == rows(apply(spark, None, first, day, "r1").select(*table.read(1).columns))
    ids = [r[0] for r in table.read().select("version_id").collect()]
    assert len(ids) == len(set(ids))


def test_added_column(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "ndc_11", ["proprietary_name", "strength"])
    table.apply(canaries(spark, range(6)), "2050-01-01", "r1")
    table.business_columns = ["proprietary_name", "strength", "approved"]
    wider = canaries(spark, range(6)).withColumn(
        "approved", F.when(F.col("ndc_11") < "99999001002", F.lit("2020-01-01").cast("date"))
    )
    outcome = table.apply(wider, "2050-01-02", "r2")
    assert (outcome["new"], outcome["changed"], outcome["unchanged"]) == (0, 2, 4)
    done = table.read()
    assert done.filter("status = 'historical' and approved is not null").isEmpty()
    assert done.filter("status = 'current' and approved is not null").count() == 2
    assert table.apply(wider, "2050-01-03", "r3")["changed"] == 0


def test_type_may_widen_only(spark):
    first = apply(spark, None, spark.createDataFrame([("k", "a", 1)], "ndc_11 string, proprietary_name string, n int"),
                  "2050-01-01", "r1", ["proprietary_name", "n"])
    wider = spark.createDataFrame([("k", "a", 2)], "ndc_11 string, proprietary_name string, n bigint")
    done = v.scd2_apply(first, wider, "ndc_11", ["proprietary_name", "n"], "2050-01-02", "r2")
    assert dict(done.dtypes)["n"] == "bigint" and done.count() == 2
    with pytest.raises(ValueError, match="cannot change"):
        v.scd2_apply(first, wider.withColumn("n", F.col("n").cast("string")), "ndc_11", ["n"], "2050-01-02", "r2")


def test_only_volatile_change_and_blank_are_no_change(spark):
    first = spark.createDataFrame([("k1", None, "x", "s1")], SCHEMA)
    again = spark.createDataFrame([("k1", "", "x", "s2")], SCHEMA)
    columns = ["proprietary_name", "strength", "source_run_id"]
    done = apply(spark, apply(spark, None, first, "2050-01-01", "r1", columns), again, "2050-01-02", "r2", columns)
    assert counts(done) == (1, 0)


def test_hash_column_guard(spark):
    df = canaries(spark, range(1))
    assert v.business_columns_only(df, ["ndc_11", "strength", "source_run_id"], "ndc_11") == ["strength"]
    with pytest.raises(ValueError, match="no business columns"):
        v.business_columns_only(df, ["ndc_11", "source_run_id"], "ndc_11")
    with pytest.raises(ValueError, match="not in the input"):
        v.business_columns_only(df, ["nope"])


@pytest.mark.parametrize("bad", [[("a",), ("a",)], [("a",), (None,)]])
def test_bad_keys_stop_the_run_before_writing(spark, tmp_path, bad):
    df = spark.createDataFrame(bad, "ndc_11 string").withColumn("strength", F.lit("x"))
    table = VersionedTable(spark, str(tmp_path / "t"), "ndc_11", ["strength"])
    with pytest.raises(Exception, match="business key"):
        table.apply(df, "2050-01-01", "r1")
    assert table.read() is None


def test_bad_keys_can_be_set_aside(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, n int")
    usable, rejected = v.split_bad_keys(df, "k")
    assert rows(usable) == [("b", 4)]
    assert sorted(r.n for r in rejected.collect()) == [1, 2, 3]


def test_random_snapshots(spark):
    """Whatever the snapshots: the day's view is the day's snapshot, and repeats change nothing."""
    chance = random.Random(7)
    done, loaded = None, []
    for number in range(5):
        day = f"2050-02-{number + 1:02d}"
        picked = [(f"k{i}", f"n{chance.randint(0, 2)}", "x", f"s{number}") for i in range(30) if chance.random() < 0.7]
        snapshot = spark.createDataFrame(picked, SCHEMA)
        done = apply(spark, done, snapshot, day, f"r{number}")
        loaded.append((day, sorted(p[:3] for p in picked)))
        stats = v.change_stats(v.match_versions(done, snapshot, "ndc_11", ["proprietary_name", "strength"])).first()
        assert (stats.new, stats.changed, stats.expired) == (0, 0, 0)
    for day, picked in loaded:
        seen = v.as_of(done, day).select("ndc_11", "proprietary_name", "strength")
        assert rows(seen) == picked
    assert_sound(done, gaps_allowed=True)
    both = v.as_of(done, loaded[2][0], "closed").count()
    assert both >= len(loaded[2][1])


def test_interval_checks(spark):
    def day(n):
        return datetime.date(2020, 1, n)

    df = spark.createDataFrame([
        ("ok", day(1), day(5)), ("ok", day(5), day(5)), ("ok", day(5), day(9)),
        ("gap", day(1), day(3)), ("gap", day(4), day(6)),
        ("over", day(1), day(9)), ("over", day(2), day(3)), ("over", day(5), day(6)),
        ("twice", day(1), day(2)), ("twice", day(1), day(2)),
    ], "k string, active_from date, active_to date")
    faults = rows(integrity.interval_faults(df, "k").select("k", "fault"))
    assert faults == [("gap", "GAP"), ("over", "OVERLAP"), ("over", "OVERLAP"), ("twice", "OVERLAP")]
    # The documented self-join counts touching rows too.
    assert rows(integrity.overlapping_pairs(df, "k")) == [("ok", 3), ("over", 2), ("twice", 1)]


def test_plan_shares_one_shuffle_between_guard_and_join(spark):
    incoming = canaries(spark, range(10))
    existing = apply(spark, None, incoming, "2050-01-01", "r1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = v.match_versions(existing, incoming, "ndc_11", ["strength"], with_rows=False)
        plan = matched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "proprietary_name" not in plan.split("Exchange hashpartitioning")[0]
