"""Landed files, quality gates, the two flows end to end, and the stream."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.plans import daily, fda, monthly
from stratalake.plans import datasets as ds
from stratalake.sinks import tables
from stratalake.sinks.versioned import VersionedTable
from stratalake.sources import documents, files
from stratalake.streaming.snapshots import version_last, version_stream
from tests.conftest import rows


def lay_out(tmp_path):
    return daily.Layout(*[str(tmp_path / n) for n in ("raw", "bronze", "silver", "gold")])


def test_delimited_reader(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("k|v\n01|\n02|x\n")
    assert rows(files.read_delimited(spark, str(path), "|")) == [("01", None), ("02", "x")]
    path.write_text("k|v\n")
    with pytest.raises(quality.QualityError):
        files.read_delimited(spark, str(path), "|")


def test_positional_reader(spark, tmp_path):
    (tmp_path / "T.RRF").write_text('1|say "hi|x|\n2||"y|\n')
    (tmp_path / "EMPTY.RRF").write_text("")
    paths = {n: str(tmp_path / n) for n in ("T.RRF", "EMPTY.RRF")} | {"UNKNOWN.RRF": "nowhere"}
    frames = files.load_positional_set(
        spark, paths, {"T": ["a", "b", "c"], "EMPTY": ["a"], "SKIPPED": ["a"]}, ["T", "EMPTY", "UNKNOWN"], "r", "d")
    assert list(frames) == ["T"]
    assert rows(frames["T"]) == [("1", 'say "hi', "x", "r", "d"), ("2", None, '"y', "r", "d")]


def test_file_matching_and_paths():
    landed = ["drop/sub\\Product.TXT", "drop/readme.md"]
    assert files.match_files(landed, ds.CDER_FILES) == {landed[0]: "fda-products"}
    assert files.run_path("base/", "r1") == "base/run_id=r1/"
    assert files.table_path("b/", "t", ["t", "u"]) == "b/t/" and files.table_path("b", "t", ["t"]) == "b/"


def test_class_list(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"rxclassMinConceptList": {"rxclassMinConcept": [\n{"classId": "1", "className": "a", "classType": "T"},\n'
        '{"classId": "2", "className": "b"}]}}')
    got = monthly.load_classes(spark, lay_out(tmp_path), str(tmp_path / "c.json"), "r1", min_rows=2)
    assert rows(got) == [("1", "a", "T", "r1"), ("2", "b", "", "r1")]
    with pytest.raises(quality.QualityError, match="rows"):
        monthly.load_classes(spark, lay_out(tmp_path), str(tmp_path / "c.json"), "r1")
    (tmp_path / "d.json").write_text('{"rxclassMinConceptList": {"rxclassMinConcept": [{"className": "a"}]}}')
    with pytest.raises(quality.QualityError, match="class_id"):
        monthly.load_classes(spark, lay_out(tmp_path), str(tmp_path / "d.json"), "r1", min_rows=0)


def test_unreadable_responses_give_nothing(spark):
    given = [("1", "SCD", "{}"), ("2", "SCD", "not json"), ("3", "SCD", None), ("4", "SCD", '{"rxclassDrugInfoList": {}}')]
    df = spark.createDataFrame(given, "product_rxcui string, product_tty string, body string")
    assert documents.drug_class_rows(df, "r").isEmpty()


def test_raw_text_is_kept_by_run(spark, tmp_path):
    df = spark.createDataFrame([("{a}",), ("{b}",)], "body string")
    for run in ("20240101_000000", "20240201_000000", "20240201_000000"):
        tables.keep_raw_text(df, "body", str(tmp_path / "raw"), run)
    kept = spark.read.text(str(tmp_path / "raw"))
    assert kept.count() == 4
    assert rows(files.latest_run(kept.withColumn("run_id", F.col("run_id").cast("string"))).select("value")) == [("{a}",), ("{b}",)]


def test_missing_tables(spark):
    spark.range(1).createOrReplaceTempView("there")
    assert quality.missing_tables(spark, ["there", "not_there"]) == ["not_there"]


def drop_fda(folder, packages):
    folder.mkdir(parents=True)
    (folder / "product.txt").write_text(
        "PRODUCTID\tPROPRIETARYNAME\tPRODUCTTYPENAME\tDOSAGEFORMNAME\tMARKETINGCATEGORYNAME\tAPPLICATIONNUMBER\t"
        "ACTIVE_NUMERATOR_STRENGTH\tACTIVE_INGRED_UNIT\tDEASCHEDULE\tNDC_EXCLUDE_FLAG\n"
        "0001-1_aaa\tOne\tHUMAN\tTABLET\tNDA\tNDA1\t5\tmg\tCII\tN\n0002-2_bbb\tTwo\tHUMAN\tKIT\tANDA\tA2\t\t\t\tE\n"
        "0003-3_ccc\tThree\tHUMAN\tGEL\tOTC\t\t1\tg\t\t\n")
    (folder / "package.txt").write_text(
        "PRODUCTID\tNDCPACKAGECODE\tPACKAGEDESCRIPTION\tSTARTMARKETINGDATE\tENDMARKETINGDATE\n" + packages)
    (folder / "Comprehensive_NDC_SPL_Data_Elements_File.csv").write_text(
        "NDC11,Proprietary Name,Dosage Form,Marketing Category,Application Number or Citation,Product Type,"
        "Marketing Start Date,Marketing End Date,Billing Unit\n"
        "00001001101,,TABLET FILM,NDA,NDA1,HUMAN,20200101,18000101,EA\n99999000001,Only here,KIT,OTC,,OTC,20210101,,ML\n")


def test_daily_flow(spark, tmp_path):
    layout = lay_out(tmp_path)
    packages = "0001-1_aaa\t0001-11-1\tbox\t20190101\t\n0002-2_bbb\t0002-22-2\tbox\t\t\n0003-3_ccc\t0003-33-3\tjar\t\t\n"
    drop_fda(tmp_path / "raw" / "run_id=r1", packages)
    first = daily.run_daily(spark, layout, "r1", "2050-01-01")
    assert (first["new"], first["version"]) == (3, 1)
    gold = VersionedTable(spark, f"{layout.gold}/fda_all_ndcs", ds.FDA_KEY, ds.FDA_BUSINESS)
    row = gold.read().filter("ndc_11 = '00001001101'").first()
    assert (row.proprietary_name, row.dosage_form, row.nsde_flag, row.spl_id, row.ndc_5) == (
        "One", "TABLET FILM", True, "aaa", "00001")
    assert (row.marketing_start_date, row.marketing_end_date) == (datetime.date(2020, 1, 1), None)
    only = gold.read().filter("ndc_11 = '99999000001'").first()
    assert (only.nsde_flag, only.source_run_id, only.source_file) == (True, "r1", "silver.fda_all_ndcs")
    assert rows(fda.controlled_items(gold.read()).select("ndc_11")) == [("00001001101",)]

    drop_fda(tmp_path / "raw" / "run_id=r2", packages.replace("box", "carton").replace("0003-33-3", "0003-33-4"))
    second = daily.run_daily(spark, layout, "r2", "2050-01-02")
    assert (second["new"], second["changed"], second["expired"], second["unchanged"]) == (1, 1, 1, 1)


def rrf(path, layout, records):
    path.write_text("".join("|".join(r.get(c, "") for c in layout) + "|\n" for r in records))


def test_monthly_flow(spark, tmp_path):
    home = {"SAB": "RXNORM", "CVF": "4096", "SUPPRESS": "N"}
    conso = [
        {"RXCUI": "1", "TTY": "SCD", "STR": "drug 5 MG Tablet"}, {"RXCUI": "1", "TTY": "PSN", "STR": "drug tab"},
        {"RXCUI": "2", "TTY": "SBD", "STR": "Brando 5 MG"}, {"RXCUI": "3", "TTY": "GPCK", "STR": "pack"},
        {"RXCUI": "10", "TTY": "IN", "STR": "Drug"}, {"RXCUI": "11", "TTY": "BN", "STR": "Brando"},
        {"RXCUI": "12", "TTY": "DF", "STR": "Tablet"}, {"RXCUI": "13", "TTY": "SBDF", "STR": "form"},
        {"RXCUI": "14", "TTY": "SCD", "STR": "gone", "SUPPRESS": "O"},
    ]
    rel = [("1", "consists_of", "c"), ("c", "has_ingredient", "10"), ("2", "tradename_of", "1"), ("1", "has_tradename", "2"),
           ("2", "has_ingredient", "11"), ("1", "has_dose_form", "12"), ("2", "has_dose_form", "12"), ("2", "isa", "13"),
           ("3", "contains", "1")]
    sat = [{"RXCUI": "1", "ATN": "RXN_AVAILABLE_STRENGTH", "ATV": "5 MG (EXPRESSED AS DRUG)"},
           {"RXCUI": "1", "ATN": "NDC", "ATV": "00001001101"}, {"RXCUI": "1", "ATN": "NDC", "ATV": "0000100110X"}]
    landed = {}
    for name, records in (
        ("RXNCONSO", [home | r for r in conso]),
        ("RXNREL", [home | {"RXCUI2": s, "RELA": r, "RXCUI1": t} for s, r, t in rel]),
        ("RXNSAT", [home | r for r in sat]),
    ):
        rrf(tmp_path / f"{name}.RRF", ds.POSITIONAL_LAYOUTS[name], records)
        landed[f"{name}.RRF"] = str(tmp_path / f"{name}.RRF")
    body = ('{"rxclassDrugInfoList": {"rxclassDrugInfo": [{"minConcept": {"rxcui": "10", "name": "Drug", "tty": "IN"}, '
            '"rxclassMinConceptItem": {"classId": "A1", "className": "x", "classType": "ATC"}, "rela": "r", "relaSource": "ATC"}]}}')
    responses = spark.createDataFrame([("1", "SCD", body), (None, "SCD", body)], "product_rxcui string, product_tty string, body string")
    layout = lay_out(tmp_path)
    stats = monthly.run_monthly(spark, layout, landed, "r1", "2050-01-01", "01012050", responses)
    assert {k: s["new"] for k, s in stats.items()} == {
        "rxnorm_products": 3, "rxnorm_ndc_mappings": 1, "rxnorm_product_classifications": 1}
    products = spark.read.parquet(f"{layout.silver}/rxnorm_products")
    got = {r.rxnorm_rxcui: r for r in products.collect()}
    assert set(got) == {"1", "2", "3"}
    assert (got["1"].rxnorm_strength, got["1"].rxnorm_ingredient_names, got["1"].rxnorm_psn) == ("5 mg", "drug", "drug tab")
    assert (got["2"].rxnorm_brand_names, got["2"].rxnorm_sbdf_name, got["2"].rxnorm_ingredient_names) == (
        "BRANDO", "BRANDO Tablet", "drug")
    assert (got["3"].rxnorm_dosage_forms, got["3"].rxnorm_multi_ingredient) == ("Pack (Tablet)", False)
    again = monthly.run_monthly(spark, layout, landed, "r2", "2050-02-01", "02012050", responses)
    assert all(s["version"] is None for s in again.values())


def test_stream_of_snapshots(spark, tmp_path):
    schema = "k string, v string, day string"
    source, landing = str(tmp_path / "in"), str(tmp_path / "landing")
    table = VersionedTable(spark, str(tmp_path / "t"), "k", ["v"])

    def arrive(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        version_stream(stream, table, "day", landing).option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

    # A snapshot in two batches, and a batch with parts of two snapshots.
    arrive(("a", "1", "2050-01-01"))
    assert table.commits().count() == 0
    arrive(("b", "1", "2050-01-01"), ("a", "2", "2050-01-02"))
    assert table.commits().count() == 1
    arrive(("a", "2", "2050-01-03"))
    assert table.commits().count() == 2
    version_last(spark, table, "day", landing, spark.createDataFrame([], schema).schema)
    assert rows(table.read().select("k", "v", "status", "active_from")) == [
        ("a", "1", "historical", datetime.date(2050, 1, 1)), ("a", "2", "current", datetime.date(2050, 1, 2)),
        ("b", "1", "historical", datetime.date(2050, 1, 1))]
    arrive(("a", "3", "2050-01-04"))
    with pytest.raises(Exception, match="versioned"):
        arrive(("z", "1", "2050-01-02"))
