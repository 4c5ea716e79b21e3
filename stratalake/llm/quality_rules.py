"""Quality rules with thresholds that follow the data.

Four statistics of each text, in thousandths and as whole numbers: mean word
length, symbols per word, share of repeated lines, share of words in repeated
three-word windows.  For each language and source, a sketch counts the documents
that pass the fixed base rules by bin: values below 128 have a bin each, larger ones share 64 bins per power of
two, so a quantile is off by 1/64 of its value at most.  Sketches merge by adding
counts.  A group of fewer than ``MIN_DOCS`` documents uses the merged sketch of
its language, and a small language that of all documents.

From a sketch come quantiles, and from them fences: an upper one for each
statistic, high + reach * max(high - q25, least spread), and a lower one for word
length, q25 less the same.  ``high`` is q75, or q99 where three quarters of the texts
have 0 and the tail is that of good texts, too; for symbols it stays q75, as more than
one text in a hundred is junk.  The least spread is near the bins' width.  The fences are joined to the documents of their group; a document that
passes the fixed base rules and lies within all fences is kept.

DataFrame functions only.  NULL and blank texts have no words: they fail the base
rules and are in no sketch.  NULL languages and sources are groups like others.
An empty table gives an empty result; columns besides id, text, language and
source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import BLANKS, column
from stratalake.session import staged

SYMBOLS = "#*$%&|<>"
MIN_DOCS = 100
# Statistic: (per cent of the upper quantile, reach, least spread in thousandths, has a lower fence).
RULES = {
    "word_length": (75, 6, 250, True),
    "symbols": (75, 8, 5, False),
    "dup_lines": (99, 0.5, 20, False),
    "repeats": (99, 0.5, 20, False),
}


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; no text, no words."""
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def repeated_words(docs: DataFrame, words: str, name: str) -> DataFrame:
    """Adds the number of words in three-word windows found twice or more in their text.

    The windows of a text are sorted, so equal ones are neighbours; what their places cover is
    counted in one pass.  All of it happens within a row.
    """
    size = F.size(words)
    windows = F.arrays_zip(
        F.slice(words, 1, size - 2).alias("a"), F.slice(words, 2, size - 2).alias("b"),
        F.slice(words, 3, size - 2).alias("c"), F.sequence(F.lit(1), size - 2).alias("at"))
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    lined = docs.withColumn("lined", F.when(size >= 3, F.sort_array(windows)))
    places = F.sort_array(F.transform(
        F.filter("lined", lambda x, i: F.coalesce(same(x, F.get("lined", i - 1)), F.lit(False))
                 | F.coalesce(same(x, F.get("lined", i + 1)), F.lit(False))),
        lambda x: x["at"]))
    counted = lined.withColumn("places", places).drop("lined")
    steps = F.zip_with("places", F.slice("places", 2, F.greatest(F.size("places") - 1, F.lit(0))),
                       lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    total = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    return counted.withColumn(name, F.coalesce(total, F.lit(0)).cast("long")).drop("places")


def text_statistics(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """The keys and, of each whole text, words, characters, symbols and repeats."""
    text = docs.select(*[column(k) for k in keys],
                       F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text_"))
    lined = text.withColumn("words_", word_array(F.col("text_"))).withColumn(
        "lines_", F.filter(F.split("text_", "\n"), lambda x: without(x, BLANKS) != ""))
    counted = lined.select(
        *[column(k) for k in keys], "words_",
        F.size("words_").cast("long").alias("n_words"),
        F.length(without(F.col("text_"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("text_") - F.length(without(F.col("text_"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines_").cast("long").alias("n_lines"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
    )
    return repeated_words(counted, "words_", "n_repeat_words").drop("words_")


def thousandths(number: str, by: str) -> Column:
    return F.expr(f"CASE WHEN {by} > 0 THEN (1000 * {number}) DIV {by} END")


def sketch_bin(value: Column) -> Column:
    """Least value of the bin: the seven leading binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return value - F.pmod(value, F.pow(F.lit(2.0), drop).cast("long"))


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, statistic, bin, n): counts, which merge by addition."""
    long = stats.where("NOT base_failed").select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), sketch_bin(column(r)).alias("bin")) for r in RULES])).alias("x"))
    return long.groupBy("lang", "source", "x.rule", "x.bin").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """First bins that reach a quarter, and the rule's upper quantile, of each group's documents.

    A group has at most some thousand bins, whatever its number of documents.
    """
    merged = sketch.groupBy(*keys, "rule", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    running = merged.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn(
        "docs", F.sum("n").over(group))
    percent = F.element_at(F.create_map(*[F.lit(x) for r, (p, *_) in RULES.items() for x in (r, p)]), F.col("rule"))
    return running.groupBy(*keys, "rule").agg(
        F.max("docs").alias("docs"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs"), F.col("bin"))).alias("q25"),
        F.min(F.when(F.col("upto") * 100 >= F.col("docs") * percent, F.col("bin"))).alias("high"))


def same_group(left: str, right: str, names: list[str]) -> Column:
    test = F.lit(True)
    for n in names:
        test = test & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return test


def fences(stats: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per language and source: low_<rule> and high_<rule>, NULL where there is no fence."""
    sketch = staged(sketches(stats), "quality-sketch")
    by_source = quantiles(sketch, ["lang", "source"]).alias("s")
    by_lang = quantiles(sketch, ["lang"]).alias("l")
    overall = quantiles(sketch, []).alias("o")
    pick = lambda q: F.when(F.col("s.docs") >= min_docs, F.col(f"s.{q}")).when(
        F.col("l.docs") >= min_docs, F.col(f"l.{q}")).otherwise(F.col(f"o.{q}"))
    chosen = (
        by_source.join(by_lang, same_group("s", "l", ["lang", "rule"]))
        .join(F.broadcast(overall), F.col("s.rule") == F.col("o.rule"))
        .select("s.lang", "s.source", "s.rule", pick("q25").alias("q25"), pick("high").alias("high"))
    )
    limits = []
    for rule, (_, reach, least, lower) in RULES.items():
        spread = F.greatest(F.col("high") - F.col("q25"), F.lit(least)) * reach
        mine = F.col("rule") == rule
        limits.append(F.max(F.when(mine, F.col("high") + spread)).alias(f"high_{rule}"))
        if lower:
            limits.append(F.max(F.when(mine, F.col("q25") - spread)).alias(f"low_{rule}"))
    return chosen.groupBy("lang", "source").agg(*limits)


def judge(docs: DataFrame, *, id_col: str = "doc_id", lang_col: str = "lang",
          source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """A row per document: its statistics, ``base_failed`` and ``kept``."""
    plain = docs.select(column(id_col).alias("doc_id"), column(lang_col).cast("string").alias("lang"),
                        column(source_col).cast("string").alias("source"), column(text_col).alias("text"))
    stats = staged(text_statistics(plain, ["doc_id", "lang", "source"]).select(
        "*",
        thousandths("word_chars", "n_words").alias("word_length"),
        thousandths("n_symbols", "n_words").alias("symbols"),
        thousandths("n_dup_lines", "n_lines").alias("dup_lines"),
        thousandths("n_repeat_words", "n_words").alias("repeats"),
        F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
    ), "quality-stats")
    within = ~F.col("base_failed")
    for rule, (*_, lower) in RULES.items():
        within = within & (F.col(f"d.{rule}") <= F.col(f"f.high_{rule}"))
        if lower:
            within = within & (F.col(f"d.{rule}") >= F.col(f"f.low_{rule}"))
    limits = fences(stats, min_docs).alias("f")
    return stats.alias("d").join(limits, same_group("d", "f", ["lang", "source"]), "left").select(
        "d.*", F.coalesce(within, F.lit(False)).alias("kept"))
