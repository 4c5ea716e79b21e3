"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words.  Sources, ordered by code point and NULL last, weigh 5, 2, 1 in
turn and share a budget of 150 % of all words; a target stops at twice the size
of its source, and what is over goes to the others by weight (found in one sweep
over the sources ordered by the share at which each is full).

The mix is a sequence of slots, a power of two of them, each a block of equal words.  Slot
k stands at the van der Corput point of k, its binary digits mirrored; the point, mapped
through the cumulative targets, names the source.  The slots of a source are ranked, and
the r-th takes the r-th block of the source's documents, which are put into seeded random
order, repeated, and cut into blocks.  The slots decide what is taken: a source has as
many blocks as points fell to it, which is its share of them but for one, and its last
block ends at its target.  A source so small that no point falls to it is not taken.  The
blocks have ``BLOCK`` words at most, and fewer where the mix would not fill ``SLOTS`` of those, so
that source is smaller than a millionth of the mix, or than ``BLOCK`` words.

DataFrame functions only.  Running totals over a source's documents and over its
slots are summed in two levels, within pieces of bounded size and over pieces, so
a source of any share is many tasks.  Equal rows are merged with their number.

A text without words takes part with size 0 and is never taken.  NULL sources
are one source.  Rows that are equal in every column share what is taken evenly.
Results depend on ids, sources, sizes and texts only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import WORD, column, fresh, row_hash
from stratalake.session import staged

WEIGHTS = (5, 2, 1)
BUDGET = (3, 2)
MOST = 2
BLOCK = 512
SLOTS = 1 << 20
# Documents of a source that are put in order by one task, about.
PIECE_ROWS = 1 << 14
SLOT_PIECE = 1 << 14
# Pieces of the unit interval by which points and sources are matched.
CELLS = 1 << 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, most: int = MOST) -> DataFrame:
    """Adds rank, weight, target and interval to (source, source_size): one row per source.

    With a budget B, a source is full at the level most * size / weight.  In order of level, the
    sources before the first one that stays below the common level are full; the rest share what
    they leave.  The input has a row per source, so one task orders it.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    levels = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn(
        "level", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("level", "rank")
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    shared = (
        levels.withColumn("all", F.sum("source_size").over(every) * (budget[0] / budget[1]))
        .withColumn("left", F.col("all") - F.coalesce(F.sum("cap").over(full), F.lit(0.0)))
        .withColumn("common", F.col("left") / F.sum("weight").over(rest))
        # The level of the mix: common levels after the first that fills no source are lower.
        .withColumn("mix_level", F.max(F.when(F.col("common") <= F.col("level"), F.col("common"))).over(every))
    )
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce("mix_level", F.lit(float("inf"))))
    taken = shared.withColumn("target", target).withColumn("words", F.floor("target"))
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("words").over(every)
    low = F.coalesce(F.sum("words").over(before), F.lit(0))
    return taken.select("source", "source_size", "rank", "target", "words", total.alias("all_words"),
                        low.alias("low"), (low + F.col("words")).alias("high"))


def running_starts(rows: DataFrame, group: str, piece: str, order: list, amount: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over earlier rows of their group, in two levels."""
    pieces = rows.groupBy(group, piece).agg(F.sum(amount).alias("held"))
    earlier = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.select(group, piece, F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy(group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(
        bases, [group, piece]).withColumn(name, F.col("base") + F.col("inside")).drop("base", "inside")


def van_der_corput(k: Column, digits: int) -> Column:
    """The binary digits of k, mirrored at the point."""
    mirrored = F.reverse(F.lpad(F.bin(k), digits, "0"))
    return F.conv(mirrored, 2, 10).cast("double") / float(1 << digits)


def block_words(all_words: int, most: int = BLOCK, slots: int = SLOTS) -> tuple[int, int]:
    """(binary digits of a slot's number, words of a block) for a mix of so many words."""
    wanted = max(1, min(most, all_words // slots))
    digits = max(1, (-(-all_words // wanted) - 1).bit_length())
    return digits, max(1, -(-all_words // (1 << digits)))


def schedule(sources: DataFrame, digits: int) -> DataFrame:
    """(slot, rank, turn): which source, by rank, and which of its blocks fills each of 2^digits slots."""
    cells = sources.where("words > 0").select(
        "rank", (F.col("low") / F.col("all_words")).alias("from"), (F.col("high") / F.col("all_words")).alias("to"))
    cells = cells.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("from") * CELLS), F.least(F.floor(F.col("to") * CELLS), F.lit(CELLS - 1)))))
    points = sources.sparkSession.range(1 << digits).withColumnRenamed("id", "slot").withColumn(
        "x", van_der_corput(F.col("slot"), digits)).withColumn("cell", F.floor(F.col("x") * CELLS))
    named = points.join(cells, "cell").where("x >= from and x < to").select(
        "slot", "rank", F.floor(F.col("slot") / SLOT_PIECE).alias("piece"))
    return running_starts(named, "rank", "piece", ["slot"], F.lit(1), "turn").select("slot", "rank", "turn")


def mix_units(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
              seed: int = 11, block: int = BLOCK, slots: int = SLOTS) -> DataFrame:
    """A row per distinct row of ``docs``: id, row hash, copies, sizes, target, words taken, first slot.

    The rows are light; the text is read once, to count its words.
    """
    light = docs.select(column(id_col).alias("doc_id"), column(source_col).cast("string").alias("source"),
                        word_count(column(text_col).cast("string")).alias("size"), row_hash(docs).alias("row"))
    units = staged(light.groupBy("doc_id", "source", "size", "row").agg(F.count(F.lit(1)).alias("copies")), "mix-units")
    sources = staged(source_targets(
        units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))), "mix-sources")
    digits, width = block_words(sources.agg(F.max("all_words")).first()[0] or 0, block, slots)
    plan = staged(schedule(sources, digits), "mix-slots")
    sources = sources.join(plan.groupBy("rank").agg(F.count(F.lit(1)).alias("have")), "rank", "left").withColumn(
        "have", F.coalesce("have", F.lit(0)))
    count = units.count()
    pieces = max(1, -(-count // PIECE_ROWS))
    placed = units.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "row")).withColumn(
        "piece", F.floor((F.col("order") / 2.0 + float(1 << 62)) / float(1 << 63) * pieces))
    named = placed.alias("u").join(sources.alias("s"),
                                   F.col("u.source").eqNullSafe(F.col("s.source"))).select(
        "u.*", "s.rank", "s.source_size", "s.target", "s.words", "s.have")
    stream = running_starts(named, "rank", "piece", ["order", "doc_id", "row"],
                            F.col("size") * F.col("copies"), "start")
    length = F.col("size") * F.col("copies")
    passes = F.explode_outer(F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(MOST - 1)), lambda e: F.col("start") + e * F.col("source_size")),
        lambda at: (at < F.col("words")) & (length > 0) & (F.col("have") > 0)))
    rounds = stream.withColumn("at", passes).withColumn("end", F.least(F.col("at") + length, F.col("words")))
    # What lies behind the last slot's block belongs to it, up to the target.
    last = F.col("have") - 1

    def turn_of(at: Column) -> Column:
        return F.least(F.floor(at / width), last)

    parts = rounds.withColumn("turn", F.explode_outer(F.when(F.col("at").isNotNull(), F.sequence(
        turn_of(F.col("at")), turn_of(F.col("end") - 1)))))
    until = F.when(F.col("turn") == last, F.col("words")).otherwise((F.col("turn") + 1) * width)
    inside = F.least(F.col("end"), until) - F.greatest(F.col("at"), F.col("turn") * width)
    joined = parts.join(plan, ["rank", "turn"], "left")
    keys = ["doc_id", "source", "size", "row", "copies", "source_size", "target"]
    return joined.groupBy(*keys).agg(
        F.sum(F.when(F.col("slot").isNotNull(), inside).otherwise(0)).alias("taken_all"),
        F.min("slot").alias("first_slot"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """A row per row of ``docs``: doc_id, size, source_size, target, taken, first_slot."""
    units = mix_units(docs, **options)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    share = F.floor(F.col("taken_all") / F.col("copies")) + F.when(
        F.col("copy") < F.col("taken_all") % F.col("copies"), 1).otherwise(0)
    return units.withColumn("copy", copy).select(
        "doc_id", "source", "size", "source_size", "target", share.cast("long").alias("taken"), "first_slot")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row is kept, repeated or left out.

    Whole documents: a row is given as often as its words are taken, rounded to the nearest, so
    only the document at a source's last block counts otherwise than by its words.
    """
    units = mix_units(docs, **options).select(
        F.col("doc_id").alias("unit_id"), "row",
        F.when(F.col("taken_all") > 0, F.floor(F.col("taken_all") / (F.col("size") * F.col("copies")) + 0.5))
        .cast("int").alias("times"))
    row, times = fresh(docs, "row"), fresh(docs, "times")
    hashed = docs.withColumn(row, row_hash(docs)).alias("d")
    chosen = units.where("times > 0").select("unit_id", F.col("row").alias("unit_row"), F.col("times").alias("unit_times"))
    id_col = options.get("id_col", "doc_id")
    given = hashed.join(chosen, (column(row) == F.col("unit_row")) & column(id_col).eqNullSafe(F.col("unit_id")))
    return given.withColumn(times, F.explode(F.sequence(F.lit(1), F.col("unit_times")))).select(
        *[F.col("d." + "`" + c.replace("`", "``") + "`") for c in docs.columns])
