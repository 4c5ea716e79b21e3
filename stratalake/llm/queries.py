"""Queries of this subpackage: each operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    collocations, decontaminate, discriminant, exact_search, licenses, linear, mixing, near_duplicates,
    oracles, quality_rules, shard, spelling, substrings, warc,
)
from stratalake.llm.common import crc32, fold, table
from stratalake.session import scratch_path, staged

SHARDS = 40


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of each document without strings of 200 bytes that start anywhere else."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
    removed = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("starts").cast("long").alias("n_spans"), "kept_sha256")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of each document against its group's fences."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside benchmark windows, and whose they are."""
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), "hits")
    return found.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hits.items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from three of four label folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 4) != 2)
    scored = linear.score(docs, linear.fit(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= linear.THRESHOLD).cast("int").alias("predicted"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document: their number, the licences, the best coefficient."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.col("notices.license"))), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max(F.col("notices.dice")), F.lit(0.0)), 6).alias("best_dice"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of equal row counts."""
    placed = shard.shuffle_into_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        crc32(F.col("text")).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    folder = scratch_path(spark, "warc")
    manifest = staged(warc.write_archives(table(spark, sf_dir, "pages"), folder), "warc-manifest")
    records = warc.read_archives(spark, manifest, folder)
    return records.select(
        warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_number("refers_to_id").alias("refers_to"), "problem")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    found = near_duplicates.find_near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from four of five label folds."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    scored = discriminant.score_quality(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot")


def op11_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    found = exact_search.nearest_by_product(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two to four words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words with their near words, the form they vary, and its root."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_quality_rules, op3_decontamination, op4_toxicity, op5_license_scan,
    op6_sharding, op7_warc, op8_near_dedup, op9_quality_classifier, op10_mixing, op11_exact_search,
    op12_collocations, op13_spelling_variants)}

ORACLES: dict[str, str] = {
    "op1_suffix_array_dedup": oracles.REPEATS,
    "op3_decontamination": oracles.CONTAMINATION,
    "op7_warc": oracles.ARCHIVED,
    "op8_near_dedup": oracles.NEAR_DUPLICATES,
    "op11_exact_search": oracles.EXACT_SEARCH,
    "op12_collocations": oracles.COLLOCATIONS,
}
