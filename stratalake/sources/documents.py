"""JSON documents as relational rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources import files

# Shapes of the two documents and the names of their fields.
CLASS_LIST_SCHEMA = (
    "rxclassMinConceptList struct<rxclassMinConcept: array<struct<"
    "classId: string, className: string, classType: string>>>"
)
DRUG_CLASSES_SCHEMA = (
    "rxclassDrugInfoList struct<rxclassDrugInfo: array<struct<"
    "minConcept: struct<rxcui: string, name: string, tty: string>, "
    "rxclassMinConceptItem: struct<classId: string, className: string, classType: string>, "
    "rela: string, relaSource: string>>>"
)


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one document each."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_raw_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, content) of every file below a folder, byte for byte.

    A file is one value, so it has to fit ``spark.sql.sources.binaryFile.maxLength``, two
    gigabytes by default; a larger one fails the read.  Spark lists no files without bytes.
    """
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", glob).load(path).select("path", "length", "content")


def damaged_documents(kept: DataFrame) -> DataFrame:
    """Kept documents whose content no longer has its length or digest."""
    sound = (F.octet_length("content") == F.col("length")) & (F.sha2("content", 256) == F.col("digest"))
    return kept.filter(~F.coalesce(sound, F.lit(False)))


def read_checked_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As ``read_json_documents``, with the text of unreadable documents, file and block.

    Write the frame before ``files.split_malformed``.
    """
    checked = f"{schema}, {files.CORRUPT} string"
    return files.with_source(spark.read.schema(checked).json(
        path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=files.CORRUPT))


def split_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, rejected) answers of products; the rejected ones with a ``reason``.

    An answer without a body, or whose body is no JSON object of the expected shape, says nothing
    about its product, other than one that lists no classes.
    """
    shape = f"{DRUG_CLASSES_SCHEMA}, {files.CORRUPT} string"
    parsed = F.from_json("body", shape, {"columnNameOfCorruptRecord": files.CORRUPT, "mode": "PERMISSIVE"})
    blank = F.col("body").isNull() | (F.trim("body") == "")
    reason = F.when(blank, "no body").when(parsed[files.CORRUPT].isNotNull(), "malformed body")
    marked = responses.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def class_rows(documents: DataFrame, run_id: str) -> DataFrame:
    """One row per class of a class list; missing fields become ``''``."""
    elements = documents.select(
        F.explode("rxclassMinConceptList.rxclassMinConcept").alias("c")
    )

    def field(name: str) -> Column:
        return F.coalesce(F.col(f"c.{name}"), F.lit(""))

    return elements.select(
        field("classId").alias("class_id"),
        field("className").alias("class_name"),
        field("classType").alias("class_type"),
        F.lit(run_id).alias("meta_run_id"),
    )


def drug_class_rows(responses: DataFrame, run_id: str) -> DataFrame:
    """One row per relationship found in the landed responses.

    ``responses`` has ``product_rxcui``, ``product_tty`` and the response text in
    ``body``.  Relationships without a concept id or a class id are left out; an
    empty response yields nothing.  Unreadable ones yield nothing either: take them out with
    ``split_responses`` first and keep them as rejects.
    """
    parsed = responses.select(
        "product_rxcui", "product_tty",
        F.explode(
            F.from_json("body", DRUG_CLASSES_SCHEMA).getField("rxclassDrugInfoList")
            .getField("rxclassDrugInfo")
        ).alias("r"),
    )

    def given(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("")) != ""

    return parsed.filter(given("r.minConcept.rxcui") & given("r.rxclassMinConceptItem.classId")).select(
        "product_rxcui",
        "product_tty",
        F.col("r.minConcept.rxcui").alias("minConcept_rxcui"),
        F.col("r.minConcept.name").alias("minConcept_name"),
        F.col("r.minConcept.tty").alias("minConcept_tty"),
        F.col("r.rxclassMinConceptItem.classId").alias("rxclassMinConceptItem_classId"),
        F.col("r.rxclassMinConceptItem.className").alias("rxclassMinConceptItem_className"),
        F.col("r.rxclassMinConceptItem.classType").alias("rxclassMinConceptItem_classType"),
        F.col("r.rela").alias("rela"),
        F.col("r.relaSource").alias("relaSource"),
        F.lit(run_id).alias("meta_run_id"),
    )
