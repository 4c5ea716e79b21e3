"""Table comparison, joins on a day, and lookups by the beginning of a token."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import compare, intervals, search
from stratalake.session import staged
from tests.conftest import rows

SCHEMA = "k string, v string, n int"


def diff(spark, left, right):
    return rows(compare.table_diff(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"]))


def test_alike_tables_give_nothing(spark):
    data = [("a", "x", 1), ("a", "x", 1), ("a", "y", 2), (None, None, None)]
    assert diff(spark, data, data[::-1]) == []
    assert diff(spark, [], []) == []


def test_each_kind_of_difference(spark):
    left = [("gone", "x", 1), ("same", "x", 1), ("value", "x", 1), ("null", None, 1), ("twice", "x", 1), (None, "x", 1)]
    right = [("new", "x", 1), ("same", "x", 1), ("value", "y", 2), ("null", "", 1), ("twice", "x", 1), ("twice", "x", 1), (None, "z", 1)]
    assert set(diff(spark, left, right)) == {
        ("gone", "TERM", None, "1", None), ("new", "ADD", None, None, "1"), ("value", "UPDATE", "v", "x", "y"),
        ("value", "UPDATE", "n", "1", "2"), ("null", "UPDATE", "v", None, ""), ("twice", "REPEATED", None, "1", "2"),
        (None, "UPDATE", "v", "x", "z")}


def test_repeated_keys(spark):
    left = [("k", "a", 1), ("k", "b", 2), ("m", "a", 1), ("m", "b", 2), ("m", "c", 3)]
    right = [("k", "a", 2), ("k", "b", 1), ("m", "a", 1), ("m", "a", 2), ("m", "c", 3)]
    got = diff(spark, left, right)
    # Values stand together otherwise in k; in m a middle value differs, which only the sums tell.
    assert got == [("k", "PAIRED", None, None, None), ("m", "UPDATE", "v", "c", "c")]


def test_columns_have_to_be_there(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="lacks: \\['n'\\]"):
        compare.table_diff(df, df.drop("n"), ["k"])
    assert rows(compare.diff_summary(compare.table_diff(
        spark.createDataFrame([("a", "x", 1), ("b", "x", 1)], SCHEMA), spark.createDataFrame([("c", "x", 1)], SCHEMA), ["k"]))) == [
        ("ADD", None, 1), ("TERM", None, 2)]


DAY = datetime.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bucket_days, rows_per_task", [(64, 2_000_000), (3, 40)])
def test_join_on_day(spark, how, bucket_days, rows_per_task):
    rnd = random.Random(4)
    facts = [(i, rnd.choice(["hot", "hot", "a", "b", "c", None]), day(rnd.choice([None, *range(400)]))) for i in range(500)]
    versions = [(rnd.choice(["hot", "hot", "a", "b", "z", None]), i, day(s), rnd.choice([day(s + rnd.randint(0, 90)), datetime.date(9999, 12, 31)]))
                for i, s in enumerate(rnd.choices(range(-100, 450), k=80))]
    want = []
    for i, key, on in facts:
        found = [v for k, v, start, end in versions if key is not None and k == key and on is not None and start <= on < end]
        want += [(i, key, on, v) for v in found] or ([(i, key, on, None)] if how == "left" else [])
    joined = intervals.join_on_day(
        staged(spark.createDataFrame(facts, "i int, k string, day date"), "facts"),
        spark.createDataFrame(versions, "k string, v int, active_from date, active_to date"),
        "k", "day", how=how, bucket_days=bucket_days, rows_per_task=rows_per_task)
    assert rows(joined.select("i", "k", "day", "v")) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_join_on_day_of_nothing(spark):
    facts = spark.createDataFrame([], "k string, day date")
    versions = spark.createDataFrame([("a", day(0), day(9))], "k string, active_from date, active_to date")
    assert intervals.join_on_day(facts, versions, "k", "day").isEmpty()
    with pytest.raises(ValueError, match="both sides"):
        intervals.join_on_day(facts.withColumnRenamed("day", "active_to"), versions, "k", "active_to")


def index(spark):
    data = [("1", "n", "apple"), ("1", "n", "apricot"), ("1", "m", "banana"), ("2", "n", "apple"), ("3", "n", "ban"), ("4", "n", "ärger")]
    return spark.createDataFrame(data, "entity_id string, field string, token string")


def test_prefix_filter_reaches_the_files(spark, tmp_path):
    search.write_index(index(spark), str(tmp_path / "i"), 3)
    found = search.begins_with(spark.read.parquet(str(tmp_path / "i")), "ap")
    assert {r[2] for r in rows(found)} == {"apple", "apricot"} and found.count() == 3
    assert "StringStartsWith(token,ap)" in found._jdf.queryExecution().executedPlan().toString()


def test_beginnings(spark):
    asked = spark.createDataFrame([(1, "ap"), (1, "banana"), (2, "ba"), (3, "ap"), (3, "zz"), (4, "är"), (5, ""), (2, "ba")],
                                  "query_id int, prefix string")
    entries = staged(index(spark), "index")
    assert rows(search.search_beginnings(asked, entries)) == [(1, "1", 2), (2, "1", 1), (2, "3", 1), (4, "4", 1)]
    assert rows(search.search_beginnings(asked, entries, match_all=False)) == [
        (1, "1", 2), (1, "2", 1), (2, "1", 1), (2, "3", 1), (3, "1", 1), (3, "2", 1), (4, "4", 1)]
    assert search.search_beginnings(asked.limit(0), entries).isEmpty()


def test_beginnings_of_equal_queries_are_matched_once(spark):
    """Hits are written out by one join of dealt queries with answers; nothing is grouped after it."""
    asked = spark.range(40).selectExpr("id query_id", "explode(array('ab', if(id % 2 = 0, 'cd', 'ab'))) prefix")
    entries = spark.range(30).selectExpr(
        "cast(id as string) entity_id", "'f' field", "explode(array('abc', if(id % 3 = 0, 'cde', 'xyz'))) token")
    got = search.search_beginnings(asked, entries, rows_per_task=50)
    assert rows(got) == sorted(
        ((q, str(e), 2 if q % 2 == 0 else 1) for q in range(40) for e in range(30) if q % 2 or e % 3 == 0),
        key=lambda r: tuple((x is None, str(x)) for x in r))
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_grid_of_queries_and_entities_repeats_few_rows(spark):
    """Entities repeated for each share of 500 would be 19 million rows here."""
    counts = spark.createDataFrame([(25_000, 38_000), (1, 1), (5, 10_000_000), (10_000_000, 5), (3, 4)], "n long, m long")
    shares, blocks = search._grid(F.col("n"), F.col("m"), 2_000_000)
    for n, m, a, b in counts.select("n", "m", shares, blocks).collect():
        assert 1 <= a <= n and 1 <= b <= m and n * m / (a * b) <= 2_000_000
        assert n * b + m * a <= 2 * (n + m) + 2 * (n * m * n * m / 2_000_000) ** 0.5


def test_beginnings_met_on_a_grid(spark):
    asked = spark.range(40).selectExpr("id query_id", "'ab' prefix")
    entries = spark.range(30).selectExpr("cast(id as string) entity_id", "'f' field", "'abc' token")
    got = search.search_beginnings(asked, entries, rows_per_task=20)
    assert "_block" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == got.distinct().count() == 40 * 30
