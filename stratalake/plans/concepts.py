"""Drug products flattened from the concept graph, and what hangs on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import text
from stratalake.operators import columns, graph, merge, quality
from stratalake.operators.aggregates import any_value, wrap_pack
from stratalake.operators.graph import Route
from stratalake.session import discard, scratch_path, staged

# Product types, home vocabulary and curated content view.
PRODUCT_TYPES = ["SCD", "SBD", "GPCK", "BPCK"]
PACK_TYPES = ["GPCK", "BPCK"]
HOME_SOURCE = "RXNORM"
CONTENT_VIEW = "4096"

SCD, SBD, PACKS = ("SCD",), ("SBD",), ("GPCK", "BPCK")

# Every walk from a product type over relations to a target type.
ROUTES = [
    Route("pin", SCD, ("consists_of", "has_precise_ingredient"), "PIN", case="lower"),
    Route("min", SCD, ("has_ingredients",), "MIN", case="lower"),
    Route("in", SCD, ("consists_of", "has_ingredient"), "IN", case="lower"),
    Route("brand_names", SCD, ("has_tradename", "has_ingredient"), "BN", case="upper"),
    Route("brand_names", SBD, ("has_ingredient",), "BN", case="upper"),
    Route("brand_names_all", SCD, ("has_tradename", "has_ingredient"), "BN", case="upper", in_view=False),
    Route("brand_names_all", SBD, ("has_ingredient",), "BN", case="upper", in_view=False),
    Route("dosage_forms", SCD + SBD, ("has_dose_form",), "DF", separator=", "),
    Route("dosage_forms_all", SCD + SBD, ("has_dose_form",), "DF", separator=", ", in_view=False),
    Route("pack_forms", PACKS, ("contains", "has_dose_form"), "DF", case="trim"),
    Route("scdf", SCD, ("isa",), "SCDF", take="first"),
    Route("scdf", SBD, ("tradename_of", "isa"), "SCDF", take="first"),
    Route("sbdf", SBD, ("isa",), "SBDF", take="first"),
    Route("sbdf", SCD, ("has_tradename", "isa"), "SBDF", take="first"),
    Route("sbd", SCD, ("has_tradename",), "SBD", take="first"),
    Route("bpck", ("GPCK",), ("has_tradename",), "BPCK", take="first"),
    Route("multi_ingredient", SCD, ("has_ingredients",), "MIN", take="exists"),
    Route("multi_ingredient", SBD, ("tradename_of", "has_ingredients"), "MIN", take="exists"),
]

# How brands and packs reach the drugs whose ingredients they have.
THROUGH = {"SBD": "tradename_of", "GPCK": "contains", "BPCK": "contains"}
RELATIONS = sorted({hop for route in ROUTES for hop in route.hops} | set(THROUGH.values()))


def in_content_view(df: DataFrame) -> Column:
    """Curated and not suppressed; the flag counts only where the frame has it."""
    curated = F.col("CVF").eqNullSafe(F.lit(CONTENT_VIEW))
    flag = columns.find_column(df, "SUPPRESS")
    return curated & columns.is_active(F.col(flag)) if flag else curated


def concept_nodes(rxnconso: DataFrame) -> DataFrame:
    return rxnconso.filter(F.col("SAB") == HOME_SOURCE).select(
        F.col("RXCUI").alias("id"), F.col("TTY").alias("type"), F.col("STR").alias("name"),
        in_content_view(rxnconso).alias("in_view"),
    )


def concept_edges(rxnrel: DataFrame) -> DataFrame:
    """Relations read from RXCUI2 to RXCUI1."""
    return rxnrel.filter(F.col("SAB") == HOME_SOURCE).select(
        F.col("RXCUI2").alias("source"), F.col("RXCUI1").alias("target"),
        F.col("RELA").alias("relation"), in_content_view(rxnrel).alias("in_view"),
    )


def base_products(nodes: DataFrame, columns: Sequence[str] = ("id", "type", "name")) -> DataFrame:
    """Distinct prescribable products, dealt by id, as all that joins them does so by id."""
    return nodes.filter(F.col("type").isin(PRODUCT_TYPES) & F.col("in_view")).select(
        *columns
    ).repartition("id").distinct()


def product_strengths(rxnsat: DataFrame) -> DataFrame:
    """(id, raw_strength): the smallest available strength of a product, lower case."""
    available = rxnsat.filter(
        (F.col("ATN") == "RXN_AVAILABLE_STRENGTH") & in_content_view(rxnsat)
    )
    return available.groupBy(F.col("RXCUI").alias("id")).agg(
        F.min(F.lower("ATV")).alias("raw_strength")
    )


def ingredient_names(base: DataFrame, edges: DataFrame, walked: DataFrame, slices: int = 1) -> DataFrame:
    """(id, ingredient_names): MIN before PIN before IN; brands and packs through their SCDs.

    With ``slices`` the edges are read, slice by slice, before this returns, and not again.
    """
    own = walked.filter(F.col("type") == "SCD").select(
        "id", merge.prefer(F.col("min"), F.col("pin"), F.col("in")).alias("ingredient_names")
    )
    related = graph.through_relation(
        base, edges, own, THROUGH, "ingredient_names", slices=slices,
    )
    # A pack without known members has an empty text, a brand without one has none.
    names = F.when(F.col("type") == "SBD", F.col("ingredient_names")).otherwise(
        F.coalesce("ingredient_names", F.lit(""))
    )
    found = merge.union_all([own, related.select("id", names.alias("ingredient_names"))])
    # Written by itself, as a filter on its ids reaches both sides of the join only from here.
    return staged(found, "ingredient-names", by="id", slices=slices) if slices > 1 else found


def drug_products(
    rxnconso: DataFrame, rxnrel: DataFrame, rxnsat: DataFrame, empty_pack_as_null: bool = True
) -> DataFrame:
    """One wide row per prescribable product.

    The walks feed both the ingredient names and the other attributes, so their
    result is written once instead of being walked twice.  The relations that they follow are
    written first, by relation, as every hop reads other ones.  Of many relations the walks and
    the products are made in slices, which bounds the disk that shuffles take.
    """
    spark, nodes = rxnconso.sparkSession, concept_nodes(rxnconso)
    stored_edges = scratch_path(spark, "edges")
    edges = graph.stored_by_relation(concept_edges(rxnrel).filter(F.col("relation").isin(RELATIONS)), stored_edges)
    slices = graph.slices_of(edges)
    base, asked = base_products(nodes), base_products(nodes, ["id", "type"])
    walked = graph.walk_edges(asked, edges, nodes, ROUTES, slices=slices)
    if slices == 1:
        walked = staged(walked, "concept-walks")
    ingredients = ingredient_names(asked, edges, walked, slices)
    if slices > 1:
        discard(spark, stored_edges)
    forms = merge.prefer(F.col("dosage_forms"), F.col("dosage_forms_all"))
    attributes = walked.select(
        "id",
        merge.prefer(F.col("brand_names"), F.col("brand_names_all")).alias("brand_names"),
        F.when(F.col("type").isin(PACK_TYPES), wrap_pack(F.col("pack_forms"), empty_pack_as_null))
        .otherwise(forms).alias("dosage_forms"),
        "sbdf_id", "scdf_id", "scdf_name", "sbd_id", "bpck_id",
        F.coalesce("multi_ingredient", F.lit(False)).alias("multi_ingredient"),
    )
    names = any_value(
        nodes.filter((F.col("type") == "PSN") & F.col("in_view")).select(
            "id", F.col("name").alias("psn")
        ),
        ["id"], "psn",
    )
    wide = merge.assemble(base, "id", [
        ingredients, product_strengths(rxnsat), attributes, names,
    ])
    products = wide.select(
        F.col("type").alias("rxnorm_tty"),
        F.col("id").alias("rxnorm_rxcui"),
        F.col("name").alias("rxnorm_str"),
        text.strip_expressed_as(F.col("raw_strength"), F.col("ingredient_names")).alias("rxnorm_strength"),
        F.col("ingredient_names").alias("rxnorm_ingredient_names"),
        F.col("brand_names").alias("rxnorm_brand_names"),
        F.col("dosage_forms").alias("rxnorm_dosage_forms"),
        F.col("psn").alias("rxnorm_psn"),
        F.col("sbdf_id").alias("rxnorm_sbdf_rxcui"),
        F.when(F.col("sbdf_id").isNotNull(), F.concat_ws(" ", "brand_names", "dosage_forms"))
        .alias("rxnorm_sbdf_name"),
        F.col("scdf_id").alias("rxnorm_scdf_rxcui"),
        F.col("scdf_name").alias("rxnorm_scdf_name"),
        F.col("sbd_id").alias("rxnorm_sbd_rxcui"),
        F.col("bpck_id").alias("rxnorm_bpck_rxcui"),
        F.col("multi_ingredient").alias("rxnorm_multi_ingredient"),
    )
    return staged(products, "products", by="rxnorm_rxcui", slices=slices) if slices > 1 else products


def code_mappings(rxnsat: DataFrame) -> DataFrame:
    """Product to package code attributes with their format checks, valid or not."""
    attributes = columns.active_only(
        rxnsat.filter(
            (F.col("ATN") == "NDC") & (F.col("SAB") == HOME_SOURCE) & (F.col("CVF") == CONTENT_VIEW)
        )
    )
    mapped = attributes.select(
        F.col("RXCUI").alias("rxcui"), F.col("ATV").alias("ndc_11"),
        "meta_run_id", "meta_release_date",
    )
    return quality.code_validity(mapped, "ndc_11")


def named_mappings(rxnsat: DataFrame, products: DataFrame) -> DataFrame:
    """Valid mappings with the product's name and type where it is prescribable."""
    valid, _ = columns.split_valid(code_mappings(rxnsat), F.col("ndc_is_valid"))
    lookup = products.select(
        "rxnorm_rxcui", F.col("rxnorm_str").alias("str"), F.col("rxnorm_tty").alias("tty")
    )
    return merge.enrich(valid, lookup, {"rxcui": "rxnorm_rxcui"}).select(
        "rxcui", "ndc_11", "str", "tty",
        F.col("ndc_length").alias("qa_ndc_length"),
        F.col("ndc_is_numeric").alias("qa_ndc_is_numeric"),
        "meta_run_id", "meta_release_date",
    )


def product_snapshot(products: DataFrame, source_table: str) -> DataFrame:
    """Products for versioning: source prefix dropped, source named."""
    return columns.strip_prefix(products, "rxnorm_").withColumn(
        "source_file", F.lit(f"silver.{source_table}")
    )


def mapping_snapshot(mappings: DataFrame, source_table: str, run_date: str) -> DataFrame:
    """Mappings for versioning, with the release they came from."""
    return columns.gold_lineage(
        mappings, f"silver.{source_table}", run_date, release_column=True
    )


def class_snapshot(members: DataFrame, source_table: str, run_date: str) -> DataFrame:
    """Product classes for versioning under short names."""
    renamed = columns.rename_existing(
        columns.lowercase_names(members),
        {
            "product_rxcui": "rxcui",
            "product_tty": "tty",
            "rxclassminconceptitem_classid": "class_id",
            "rxclassminconceptitem_classname": "class_name",
            "rxclassminconceptitem_classtype": "class_type",
        },
    )
    return columns.gold_lineage(renamed, f"silver.{source_table}", run_date)
