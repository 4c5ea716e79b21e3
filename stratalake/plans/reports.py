"""Documented questions to the versioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators import aggregates, merge
from stratalake.operators.columns import contains_text
from stratalake.operators.versioning import CURRENT

# Parts by product into which the members of each class are dealt.
SHARES = 256


def class_profile(members: DataFrame, product: str) -> DataFrame:
    """All classes of one product, by source and class type."""
    return members.filter(F.col("rxcui") == product).select(
        "rxcui", "tty", F.col("minconcept_name").alias("ingredient"),
        F.col("class_name").alias("classification"), "class_type", "rela", "relasource",
    ).orderBy("relasource", "class_type", "classification", "rela", "ingredient")


def products_for_condition(
    members: DataFrame, condition: str, relations: Sequence[str], class_type: str
) -> DataFrame:
    """Products with a class whose name holds a text, related in one of the given ways."""
    return members.filter(
        contains_text("class_name", condition)
        & F.col("rela").isin(list(relations)) & (F.col("class_type") == class_type)
    ).select(
        "rxcui", "tty", F.col("minconcept_name").alias("ingredient"),
        F.col("class_name").alias("condition"), "rela", "relasource",
    ).distinct().orderBy("ingredient", "tty", "rxcui", "condition", "rela", "relasource")


def _of_product(members: DataFrame, product: str | None) -> DataFrame:
    return members if product is None else members.filter(F.col("rxcui") == product)


def label_classes(members: DataFrame, source: str, product: str | None = None) -> DataFrame:
    """Distinct classes that one source gives each product, or the one asked for."""
    return _of_product(members, product).filter(F.col("relasource") == source).select(
        "rxcui", F.col("minconcept_name").alias("ingredient"),
        F.col("class_name").alias("classification"), "class_type", "rela",
    ).distinct()


def contraindications(
    members: DataFrame, relation: str, class_type: str, product: str | None = None
) -> DataFrame:
    """Distinct classes that each product, or the one asked for, is related to in one way."""
    return _of_product(members, product).filter(
        (F.col("rela") == relation) & (F.col("class_type") == class_type)
    ).select("rxcui", F.col("class_name").alias("contraindicated_condition")).distinct()


def with_source_code(products: DataFrame, members: DataFrame, source: str) -> DataFrame:
    """Products with the class id and name of one source, where it has them."""
    codes = members.select(
        "rxcui", "relasource", F.col("class_id").alias("code"), F.col("class_name").alias("code_name")
    )
    found = merge.enrich(
        products, codes, {"rxcui": "rxcui"}, where=F.col("relasource") == source
    )
    return found.drop("relasource")


def classes_per_source(members: DataFrame) -> DataFrame:
    return aggregates.distinct_per_group(members, ["relasource"], "class_id", "num_classes")


def coverage_by_type(members: DataFrame) -> DataFrame:
    """Products, classifications and their ratio by product type."""
    return aggregates.rows_per_entity(
        members, ["tty"], "rxcui", "num_classifications", "num_products", "avg_per_product"
    ).orderBy(F.desc("num_products"), "tty")


def source_relation_counts(members: DataFrame) -> DataFrame:
    return aggregates.group_counts(members, ["relasource", "rela"], "count").orderBy(
        F.desc("count"), "relasource", "rela"
    )


def multi_ingredient(products: DataFrame) -> DataFrame:
    return products.filter((F.col("status") == CURRENT) & F.col("multi_ingredient")).select(
        "rxcui", "str", "ingredient_names", "strength"
    )


def by_ingredient(products: DataFrame, ingredient: str) -> DataFrame:
    return products.filter(
        (F.col("status") == CURRENT) & contains_text("ingredient_names", ingredient)
    ).select("rxcui", "str", "ingredient_names", "brand_names")


def lookup_classes(members: DataFrame, products: DataFrame) -> DataFrame:
    """Classes of the given products (``rxcui``), a row each."""
    return members.join(products.select("rxcui"), "rxcui", "left_semi").select(
        "rxcui", "class_id", "class_name", "class_type", "rela", "relasource"
    ).distinct()


def lookup_products(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Products of the given classes (``class_id``), a row each.

    A few classes may hold most members, so members meet their class by class and a share of the
    products.  The shares that a class has are found first and meet the given classes; equal rows fall
    into one share, so the distinct needs no other shuffle.
    """
    columns = ["class_id", "class_name", "rxcui", "tty", "rela", "relasource"]
    shared = members.select(*columns).withColumn("_share", F.pmod(F.xxhash64("rxcui"), F.lit(SHARES)).cast("int"))
    wanted = shared.select("class_id", "_share").distinct().join(
        classes.select("class_id").distinct(), "class_id", "left_semi")
    return shared.join(wanted, ["class_id", "_share"], "left_semi").select(*columns, "_share").distinct().drop("_share")


def classes_of(members: DataFrame) -> DataFrame:
    """Drug to classes: how many classes and sources each product has."""
    return members.groupBy("rxcui").agg(
        F.count_distinct("class_id").alias("classes"),
        F.count_distinct("relasource").alias("sources"),
    )


def members_of(members: DataFrame) -> DataFrame:
    """Class to drugs: how many products each class has."""
    return members.select("class_id", "class_type", "rxcui").distinct().groupBy(
        "class_id", "class_type"
    ).agg(F.count(F.lit(1)).alias("products"))
