"""Near duplicates by HyperMinHash.

A text's set is its distinct five-word shingles, as 64-bit hashes.  Its sketch has
128 registers; a register holds the least value of its hash function over the
set, compressed to the count of leading zeros (6 bits) and the 10 bits after the
first one.  Each register has a hash function of its own, so short texts have no
empty ones.  Four registers make a band; texts that share a band are compared.
At a similarity of 0.75 a pair shares none of the 32 bands with probability
(1 - 0.75^4)^32 = 5e-6.

Texts of one set are one node.  Within a band's bucket, nodes are compared with
the bucket's centre, the node that shares most over all of its bands, first by
the estimate from the registers, corrected for registers that agree by chance,
then exactly, on the full sets.  A group of n copies so costs n comparisons.
Components are found by alternating star contraction on the confirmed links.

Buckets that still hold several components get a second round.  What the first one
measured bounds what any other pair can have in common: shingles that no other
node of these buckets has, and shingles of the centre that a node has lost, which
another node that kept them cannot share.  Nodes that no other of their bucket can
link with leave first.  The rest is looked at in blocks of a bounded number of nodes,
where numbers alone are compared: a pair becomes a row only if the bounds of both
sides allow a link and its registers do, in the first bucket that it shares.  No link
between candidates is lost, and a group of loosely similar texts is never written
out pair by pair.

Every round is written to the shared folder.  Nothing is collected: hot buckets
are aggregated before they are shuffled, and joins are left to adaptive
execution.

Texts with fewer than five words have their whole sequence as one shingle.  NULL
and blank texts have an empty set and are linked with nothing.  A NULL id is
never the smallest unless its component has no other.  Equal rows are one node.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import column, fresh, row_hash, rows_by_batch, utf8
from stratalake.session import staged

WORDS = 5
# Similarity as a ratio of whole numbers.
LEAST = (75, 100)
REGISTERS, BAND = 128, 4
MANTISSA = 10
# Standard deviations that an estimate may lie below the threshold.
MARGIN = 5.0
PIECE = 1 << 20
# Nodes of a bucket in one block of the second round.
BLOCK = 1024

_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_random = np.random.Generator(np.random.PCG64(20_240_501))
_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_CODES[_IS_SPACE] = 0
_MULTIPLIERS = _random.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15


def _powers(count: int) -> np.ndarray:
    out = np.full(count, _STEP, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP = _powers(1 << 12)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lowered, a piece of the text at a time."""
    out, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            found = _SPACE.search(text, end)
            end = found.start() if found else len(text)
        data = _LOWER[np.frombuffer(text[at:end], np.uint8)]
        solid = ~_IS_SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        starts = np.flatnonzero(begins)
        if len(starts):
            inside = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) \
                if starts[0] == 0 else None
            if inside is None:
                data, starts = data[starts[0]:], starts - starts[0]
                inside = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
            powers = _UP if inside.max() < len(_UP) else _powers(int(inside.max()) + 1)
            out.append(scramble(np.add.reduceat(_CODES[data] * powers[inside], starts)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """The sorted set of a text."""
    words = word_hashes(text)
    width = min(WORDS, len(words))
    if not width:
        return words
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * np.uint64(_STEP) + words[k:len(words) - width + 1 + k]
    return np.unique(scramble(total))


def registers(items: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the least value of each hash function."""
    least = np.full(REGISTERS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(items), 512):
        least = np.minimum(least, (items[at:at + 512, None] * _MULTIPLIERS).min(axis=0))
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.minimum(np.maximum(64 - exponent, 0), 63)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return (zeros * (1 << MANTISSA) + np.clip(mantissa, 0, (1 << MANTISSA) - 1)).astype(np.uint16)


def chance_equal(a, b):
    """Probability that registers of disjoint sets of these sizes agree.

    The minima have densities a e^(-av) and b e^(-bv); a register holds values up to a part
    1 / 2^MANTISSA of their leading digit apart, 1 / (2 ln 2) of that on average.
    """
    return a * b / (a + b) ** 2.0 / (2 * np.log(2)) / (1 << MANTISSA)


def estimated(same, a, b):
    """Similarity from the share of equal registers, without those that agree by chance."""
    chance = chance_equal(a, b)
    return (same / REGISTERS - chance) / (1 - chance)


def met(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join whose sides grow with the input: shuffled at every size, never broadcast by the driver."""
    return left.join(right.hint("merge"), on, how)


def sketch(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, node, registers) of each row; node names its set, NULL if empty."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("row", T.LongType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()),
        T.StructField("registers", T.BinaryType())])
    plain = docs.select(column(id_col).alias("doc_id"), row_hash(docs).alias("row"),
                        column(text_col).cast("string").alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            sizes, nodes, marks = [], [], []
            for text in utf8(batch, "text"):
                items = shingles(text)
                sizes.append(len(items))
                nodes.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                marks.append(registers(items).tobytes() if len(items) else None)
            yield {"doc_id": batch.column(0), "row": batch.column(1), "n_shingles": sizes,
                   "node": nodes, "registers": marks}

    return rows_by_batch(plain, schema, make)


def bands_of():
    """Array of a hash of each band of registers, and of its number."""
    width = 2 * BAND
    return F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda i: F.xxhash64(
        i, F.col("registers").substr(i * width + 1, F.lit(width))))


def shared_bands(nodes: DataFrame) -> DataFrame:
    """Bands of several nodes, with their number of nodes."""
    every = nodes.select(F.explode(bands_of()).alias("band"), "node")
    counts = every.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return met(every, counts, "band")


def bucket_centres(shared: DataFrame) -> DataFrame:
    """(band, centre): the node of most company over all of its bands."""
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = met(shared.select("band", "node"), weights, "node")
    return weighed.groupBy("band").agg(F.max(F.struct("weight", "node"))["node"].alias("centre"))


def centre_pairs(shared: DataFrame, centres: DataFrame) -> DataFrame:
    """(a, b): each node with the centre of each of its buckets."""
    return met(shared.select("band", "node"), centres, "band").where("node <> centre").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def mixed_buckets(shared: DataFrame, linked: DataFrame) -> DataFrame:
    """(band, node, component) of buckets that hold several components."""
    placed = met(shared.select("band", "node"), linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return met(placed, mixed.select("band"), "band")


def alone(texts: DataFrame) -> DataFrame:
    """(node, alone): shingles that no other of these nodes has, where there are any."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("shingle", T.LongType())])

    def make(batches):
        for batch in batches:
            nodes, items = [], []
            for node, text in zip(batch.column("node").to_pylist(), utf8(batch, "text")):
                found = shingles(text)
                nodes += [node] * len(found)
                items.append(found)
            yield {"node": nodes, "shingle": (np.concatenate(items) if items else np.empty(0, np.uint64)).view(np.int64)}

    single = rows_by_batch(texts.select("node", "text"), schema, make).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    return single.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))


def crossing_pairs(
    mixed: DataFrame, nodes: DataFrame, centres: DataFrame, measured: DataFrame, unique: DataFrame,
    tested: DataFrame,
) -> DataFrame:
    """(a, b): pairs of different components that share a bucket and may be linked, by their bounds and registers.

    With sizes x and y, a link needs c >= p (x + y) / (p + q) common shingles for a similarity of
    p / q.  Two bounds on what y has and x has not rule pairs out.

    * What is alone in x or in y is not common.
    * Of the centre's shingles that x has lost, y has all but those it has lost itself; what is
      alone in y comes on top, as the centre has it not.
    """
    p, q = LEAST
    sizes = nodes.select("node", F.col("n_shingles").alias("n"), "registers", bands_of().alias("bands"))
    centre_sizes = nodes.select(F.col("node").alias("centre"), F.col("n_shingles").alias("centre_n"))
    common = measured.select(F.col("a").alias("ma"), F.col("b").alias("mb"), "common")
    known = met(met(mixed, sizes, "node"), unique, "node", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    known = met(met(known, centres, "band"), centre_sizes, "centre")
    known = met(known, common, (F.least("node", "centre") == F.col("ma")) & (F.greatest("node", "centre") == F.col("mb")), "left")
    is_centre = F.col("node") == F.col("centre")
    lost = F.when(is_centre, 0).otherwise(F.col("centre_n") - F.col("common"))
    spare = F.when(is_centre, 0).otherwise(F.coalesce(lost, F.col("centre_n")) - F.col("alone"))
    bounded = known.select(
        "band", "node", "component", "n", "registers",
        ((p + q) * (F.col("n") - F.col("alone")) - p * F.col("n")).alias("room"),
        ((p + q) * F.coalesce(lost, F.lit(0)) + p * F.col("n")).alias("needs"),
        (q * F.col("n") + (p + q) * spare).alias("gives"),
        F.expr("slice(bands, 1, cast(array_position(bands, band) - 1 as int))").alias("earlier"))
    # First against the extremes of the bucket, then pair by pair within blocks.
    extremes = bounded.groupBy("band").agg(
        F.min("n").alias("least_n"), F.max("gives").alias("most"), F.min("needs").alias("least_needs"))
    able = met(bounded, extremes, "band").where(
        (F.col("room") >= p * F.col("least_n")) & (F.col("needs") <= F.col("most"))
        & (F.col("gives") >= F.col("least_needs"))).drop("least_n", "most", "least_needs")
    able = staged(able, "near-able")
    found = block_pairs(able)
    return met(found, tested, ["a", "b"], "left_anti")


def block_pairs(able: DataFrame) -> DataFrame:
    """(a, b): pairs of a bucket that their bounds and registers allow, from blocks of ``BLOCK`` nodes.

    A bucket of more nodes is dealt over several lines, and every two lines meet in a block of their own.
    """
    p, q = LEAST
    lines = able.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("lines"),
                                     F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    dealt = met(able, lines, "band").withColumn("line", F.pmod(F.xxhash64("node"), F.col("lines").cast("long")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lines") - 1)))
    block = F.xxhash64("band", F.least("line", "other"), F.greatest("line", "other"))
    columns = ["block", "band", "line", "other", "node", "component", "n", "room", "needs", "gives", "registers", "earlier"]
    placed = dealt.withColumn("block", block).select(*columns).repartition("block").sortWithinPartitions("block", "band")
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    floor = estimate_floor()

    def pairs_of(group: pa.Table) -> tuple[list, list]:
        number = {name: group[name].to_numpy() for name in ("n", "room", "needs", "gives", "line")}
        n, room, needs, gives, line = number.values()
        component = group["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        marks = np.frombuffer(b"".join(group["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        nodes, earlier = group["node"].to_pylist(), None
        first, second = [], []
        two_lines = line.min() != line.max()
        for x in range(len(n) - 1):
            y = np.arange(x + 1, len(n))
            fits = (component[y] != component[x]) & (room[x] >= p * n[y]) & (room[y] >= p * n[x]) \
                & (needs[x] <= gives[y]) & (needs[y] <= gives[x]) \
                & (np.minimum(n[x], n[y]) * q >= np.maximum(n[x], n[y]) * p)
            if two_lines:
                fits &= line[y] != line[x]
            y = y[fits]
            if len(y):
                y = y[estimated((marks[y] == marks[x]).sum(axis=1), n[x], n[y]) >= floor]
            for at in y.tolist():
                if earlier is None:
                    earlier = [set(bands) for bands in group["earlier"].to_pylist()]
                if earlier[x].isdisjoint(earlier[at]):
                    first.append(min(nodes[x], nodes[at]))
                    second.append(max(nodes[x], nodes[at]))
        return first, second

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for group in runs(batches, "block"):
            bands, line, other = (group[name].to_numpy() for name in ("band", "line", "other"))
            cells = np.stack([bands, np.minimum(line, other), np.maximum(line, other)], axis=1)
            # Different blocks may share a hash.
            for cell in np.unique(cells, axis=0) if (cells != cells[0]).any() else cells[:1]:
                own = (cells == cell).all(axis=1)
                first, second = pairs_of(group if own.all() else group.filter(pa.array(own)))
                if first:
                    yield {"a": first, "b": second}

    return rows_by_batch(placed, schema, make)


def runs(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.Table]:
    """The rows of each value of a column, by which the batches are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(name).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and held[-1].column(name)[0].as_py() != values[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def estimate_floor() -> float:
    """The least estimate of a pair that may be linked."""
    least = LEAST[0] / LEAST[1]
    return least - MARGIN * float(np.sqrt(least * (1 - least) / REGISTERS))


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose estimate does not rule out a link."""
    bits = nodes.select("node", "registers", "n_shingles")
    both = met(met(pairs, bits.select(F.col("node").alias("a"), F.col("registers").alias("ra"), F.col("n_shingles").alias("na")), "a"),
               bits.select(F.col("node").alias("b"), F.col("registers").alias("rb"), F.col("n_shingles").alias("nb")), "b")
    sized = both.where(F.least("na", "nb") * LEAST[1] >= F.greatest("na", "nb") * LEAST[0])
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    floor = estimate_floor()

    def make(batches):
        for batch in batches:
            def matrix(name):
                return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            keep = pa.array(estimated((matrix("ra") == matrix("rb")).sum(axis=1), batch.column("na").to_numpy(),
                                      batch.column("nb").to_numpy()) >= floor) if batch.num_rows else pa.array([], pa.bool_())
            yield {n: batch.column(n).filter(keep) for n in ("a", "b")}

    return rows_by_batch(sized.select("a", "b", "ra", "rb", "na", "nb"), schema, make)


def measured_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs with their common shingles, counted on the full sets, and whether they are linked."""
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()),
                           T.StructField("common", T.LongType()), T.StructField("linked", T.BooleanType())])
    both = met(met(pairs, texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"),
               texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def make(batches):
        last, mine = None, None
        for batch in batches:
            out = {n: [] for n in schema.names}
            ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            for (a, b), one, other in zip(ids, utf8(batch, "text_a"), utf8(batch, "text_b")):
                if b != last:
                    # Rows come in order of b, so its set is made once.
                    last, mine = b, shingles(other)
                theirs = shingles(one)
                total = len(theirs) + len(mine)
                common = total - len(np.union1d(theirs, mine))
                for n, value in zip(schema.names, (a, b, common, LEAST[1] * common >= LEAST[0] * (total - common))):
                    out[n].append(value)
            yield out

    return rows_by_batch(both.select("a", "b", "text_a", "text_b"), schema, make)


def node_texts(docs: DataFrame, sketches: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text): one text of each node in ``wanted``."""
    holders = met(sketches, wanted, "node").groupBy("node").agg(F.min(F.struct("row", "doc_id")).alias("h")).select(
        "node", "h.row", F.col("h.doc_id").alias("holder"))
    plain = docs.select(column(id_col).alias("doc_id"), row_hash(docs).alias("row"),
                        column(text_col).cast("string").alias("text"))
    found = met(plain, holders, (plain["row"] == holders["row"]) & plain["doc_id"].eqNullSafe(holders["holder"]))
    return found.groupBy("node").agg(F.min("text").alias("text"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that is reachable, for every linked node."""
    stars = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-stars")
    before = None
    while True:
        mark = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = mark
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: greater neighbours of a node move to its least one.
        large = met(both, least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its lesser neighbours move to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = met(large, least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = staged(least.select("a", F.col("m").alias("b")).unionByName(small).distinct(), "near-stars")


def find_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, row, n_shingles, component_id."""
    sketches = staged(sketch(docs, id_col=id_col, text_col=text_col), "near-sketches")
    nodes = staged(sketches.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.max("n_shingles").alias("n_shingles"),
        F.max("registers").alias("registers")), "near-nodes")
    shared = staged(shared_bands(nodes), "near-bands")
    centres = staged(bucket_centres(shared), "near-centres")
    tested = staged(centre_pairs(shared, centres), "near-pairs")
    texts = staged(node_texts(docs, sketches, shared.select("node").distinct(), id_col, text_col), "near-texts")
    first = staged(measured_pairs(likely(tested, nodes), texts), "near-measured")
    links = first.where("linked").select("a", "b")
    linked = components(links)
    mixed = staged(mixed_buckets(shared, linked), "near-mixed")
    unique = alone(met(texts, mixed.select("node").distinct(), "node"))
    crossing = crossing_pairs(mixed, nodes, centres, first, unique, tested)
    second = staged(measured_pairs(crossing, texts), "near-measured").where("linked").select("a", "b")
    if not second.isEmpty():
        linked = components(links.unionByName(second))
    named = met(nodes.select("node", "least_id"), linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = met(named, smallest, "component").select("node", "component_id", "component")
    return met(sketches.select("doc_id", "row", "n_shingles", "node"), ids, "node", "left").select(
        "doc_id", "row", "n_shingles", "component",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one of the smallest id, with its columns.

    Documents without words are in no group and stay.  Rows that tie, as they share the smallest
    id, are cut to the one of the least row hash, and equal ones to one.
    """
    found = find_near_duplicates(docs, id_col=id_col, text_col=text_col)
    best = found.where("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("n"))
    chosen = best.select(F.col("best.row").alias("keep_row"), F.col("best.doc_id").alias("keep_id"),
                         (F.col("n") > 1).alias("ties"))
    empty = found.where("component is null").select(
        F.col("row").alias("keep_row"), F.col("doc_id").alias("keep_id"), F.lit(False).alias("ties")).distinct()
    keep = staged(chosen.unionByName(empty), "near-kept")
    row = fresh(docs, "row")
    held = met(
        docs.withColumn(row, row_hash(docs)), keep, (column(row) == F.col("keep_row")) & column(id_col).eqNullSafe(F.col("keep_id")))
    names = [column(c) for c in docs.columns]
    # Only kept rows of groups are looked at for equal rows.
    once = held.where("ties").dropDuplicates([row, "keep_id"])
    return held.where(~F.col("ties")).select(*names).unionByName(once.select(*names))
