"""Schema application, filters, codes, text and token rules on edge cases."""

import datetime

from pyspark.sql import functions as F

from stratalake.functions import casting, text
from stratalake.functions.hashing import fingerprint, name_based_id
from stratalake.operators import aggregates, columns, merge
from stratalake.plans import datasets as ds
from tests.conftest import rows


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


def test_safe_dates(spark):
    given = ["", "   ", None, "abc", "18991231", "19000101", "2024-01-05", "20240105"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    kept = {r.i: r.d for r in df.select("i", casting.safe_date(F.col("v")).alias("d")).collect() if r.d}
    assert kept == {5: datetime.date(1900, 1, 1), 7: datetime.date(2024, 1, 5)}


def test_apply_schema_orders_and_casts(spark):
    df = spark.createDataFrame([("1", "x", "2.505", "true", "keep")], "`A B` string, n string, `d.e` string, f string, extra string")
    got = columns.apply_schema(df, {
        "n": {"target_name": "number", "type": "integer"},
        "A B": {"target_name": "a", "type": "long"},
        "d.e": {"target_name": "d", "type": "decimal"},
        "f": {"target_name": "flag", "type": "boolean"},
        "missing": {"target_name": "m"},
    })
    assert got.dtypes == [
        ("number", "int"), ("a", "bigint"), ("d", "decimal(10,2)"), ("flag", "boolean"), ("extra", "string"),
    ]
    row = got.first()
    assert (row.number, row.a, str(row.d), row.flag, row.extra) == (None, 1, "2.51", True, "keep")
    assert columns.apply_schema(df, None) is df


def test_active_and_excluded_flags(spark):
    df = spark.createDataFrame([("N",), ("",), (None,), ("Y",), ("O",), ("E",)], "suppress string")
    assert columns.active_only(df).count() == 3
    assert columns.active_only(df.withColumnRenamed("suppress", "x")).count() == 6
    assert [r[0] for r in rows(columns.exclude_value(df, "suppress", "E"))] == ["", "N", "O", "Y", None]


def test_package_codes(spark):
    given = ["1234-567-8", "12345-6789-01", "12345-6789", None, "123456-7890-12"]
    df = spark.createDataFrame([(v,) for v in given], "v string")
    got = [r[0] for r in df.select(text.package_code(F.col("v"))).collect()]
    assert got == ["01234056708", "12345678901", None, None, "12345789012"]
    assert one(spark, text.labeler_code(F.col("v")), "01234056708") == "01234"
    assert one(spark, text.part_of(F.col("v"), "_", 1), "a_b") == "b"


def test_strength_remark(spark):
    df = spark.createDataFrame([
        ("10 MG (EXPRESSED AS ASPIRIN)", "aspirin"), ("10 MG (EXPRESSED AS A (B))", "a (b)"),
        ("10 MG (EXPRESSED AS X)", None), ("5 MG", None), ("10 MG (EXPRESSED AS X)", "y"), (None, "a"),
    ], "s string, i string")
    got = [r[0] for r in df.select(text.strip_expressed_as(F.col("s"), F.col("i"))).collect()]
    assert got == ["10 mg", "10 mg", "10 mg (expressed as x)", "5 mg", "10 mg (expressed as x)", None]


def test_tokens(spark):
    given = "The Quick/brown|fox\tAND a 500 mg FOX x of\x1cform"
    assert one(spark, text.tokens(F.col("v")), given) == ["quick", "brown", "fox", "500", "fox", "form"]
    assert one(spark, text.tokens(F.col("v")), "") == []
    assert one(spark, text.tokens(F.col("v")), None) is None
    assert len(text.STOP_WORDS) == len(set(text.STOP_WORDS)) == 60


def test_item_key_with_a_missing_part(spark):
    assert one(spark, text.key_path("token", F.col("v"), "DRUG"), "abc") == "token#abc#DRUG"
    assert one(spark, text.key_path("DRUG", F.col("v")), None) is None


def test_joined_sets(spark):
    df = spark.createDataFrame(
        [("a", "B"), ("a", "b"), ("a", None), ("n", None), ("n", None), ("c", "z"), ("c", "Y")], "k string, v string"
    )
    got = df.groupBy("k").agg(
        aggregates.set_text(F.lower("v"), " / ").alias("s"),
        aggregates.wrapped_set_text(F.col("v")).alias("p"),
        aggregates.wrapped_set_text(F.col("v"), empty_as_null=False).alias("q"),
        aggregates.has_any(F.col("v")).alias("h"),
    )
    assert rows(got) == [
        ("a", "b", "Pack (B / b)", "Pack (B / b)", True), ("c", "y / z", "Pack (Y / z)", "Pack (Y / z)", True),
        ("n", "", None, "Pack ()", False),
    ]


def test_any_value_takes_one_row(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, "b", "x"), (1, "c", "a"), (2, None, "q")], "k int, a string, b string")
    assert rows(aggregates.any_value(df, ["k"], "a", "b")) == [(1, "b", "x"), (2, None, "q")]


def test_preference_and_fallback(spark):
    df = spark.createDataFrame([("", None, "c"), ("a", "b", "c"), (None, "", None)], "a string, b string, c string")
    assert [r[0] for r in df.select(merge.prefer(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["c", "a", None]


def test_fingerprint_rules(spark):
    df = spark.createDataFrame(
        [(1, None, 1.5, datetime.date(2020, 1, 2), True), (1, "", 1.5, datetime.date(2020, 1, 2), True)],
        "i int, s string, x double, d date, b boolean",
    )
    hashes = [r[0] for r in df.select(fingerprint(df, ["i", "s", "x", "d", "b"])).collect()]
    assert hashes[0] == hashes[1]
    import hashlib
    assert hashes[0] == hashlib.md5(b"1||1.500000|2020-01-02|true").hexdigest()
    made = df.select(name_based_id(F.col("i"), F.col("s"))).first()[0]
    assert [len(p) for p in made.split("-")] == [8, 4, 4, 4, 12]


def test_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "rxnorm_a int, META_RUN_ID int, b int")
    assert columns.strip_prefix(df, "rxnorm_").columns == ["a", "META_RUN_ID", "b"]
    lined = columns.gold_lineage(df, "silver.t", "2050-01-01", release_column=True)
    assert lined.columns == ["rxnorm_a", "source_run_id", "b", "source_release_date", "source_file"]
    assert columns.add_prefix(df, "x_", skip=["b"]).columns == ["x_rxnorm_a", "x_META_RUN_ID", "b"]


def test_table_names():
    assert ds.table_names("bronze", "fda-cder", {"file_table_mapping": ds.CDER_FILES}) == ["fda-products", "fda-packages"]
    assert ds.table_names("bronze", "rxnorm", {"tables": {"RXNREL": "x"}}) == ["RXNREL"]
    assert ds.table_names("bronze", "rxclass", {}) == ["rxclass"]
    assert ds.table_names("silver", "fda-all-ndcs", {}) == ["fda_all_ndcs"]
    assert ds.table_names("gold", "rxnorm-products", {}) == ["rxnorm_products"]
