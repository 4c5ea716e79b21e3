"""Phrase collocations by top-order marginalisation.

Every word of a piece leads a window of up to four words, padded at the end of its piece.  Only
these longest windows are counted; one ROLLUP over (lang, w1, w2, w3, w4) then sums them to the counts
of all shorter phrases, as each occurrence of a phrase is the beginning of exactly one window.

A phrase that counts has ``least`` occurrences, and so has each of its beginnings.  So a window may be
padded from the first word on where its phrase cannot be frequent, and nothing that counts is lost.
Which phrases can be frequent is found beforehand, in one pass: tasks send sorted 40-bit hashes of
their phrases with counts, in parts by hash; each part adds them up and gives a piece of a bitmap of
the frequent ones.  The bitmap has 2^27 bits, whatever the input, which bounds what is broadcast.
Phrases that share a bit with a frequent one pass needlessly, which costs time and never changes a
count: the counts are those of the words themselves.

NULL texts have no words, a NULL language counts as ``und``.  Arithmetic is that of whole numbers.
Repeated rows count each time.  An empty table gives an empty result.  A long text is taken in parts
that end where a piece ends.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import column, rows_by_batch, utf8
from stratalake.session import staged

ORDER = 4
LEAST = 30
TOP = 2000
HASH_BITS, MAP_BITS = 40, 27
# Text that is counted at once in a task, and text behind one part of the hashes.
BLOCK = 8 << 20
PART = 8 << 20

_CUT = re.compile(rb"[.,;:!?\x0a-\x0d]")
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def parts_of(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``BLOCK`` bytes that end with a piece."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + BLOCK) if len(text) - at > BLOCK else None
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, text): texts of a language joined into blocks, parted by line feeds."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch, "text")):
            for part in parts_of(text):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                total += len(part)
                if total >= 2 * BLOCK:
                    # The fullest language goes; those with few texts gather more.
                    most = max(sizes, key=sizes.get)
                    total -= sizes.pop(most)
                    yield most, b"\n" + b"\n".join(held.pop(most)) + b"\n"
    for lang, texts in held.items():
        yield lang, b"\n" + b"\n".join(texts) + b"\n"


def words_of(block: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number of each word, the distinct words by number, and the number of each word's piece."""
    data = _LOWER[np.frombuffer(block, np.uint8)]
    kind = _KIND[data]
    solid = kind == 0
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    steps = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(steps.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[solid]))])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.searchsorted(np.flatnonzero(kind == 2), starts)


def phrase_hashes(lang: str, numbers: np.ndarray, words: pa.Array, piece: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 2, 3 and 4 words: 40-bit hashes of the phrase from each word, and whether it ends in its piece."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    single = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))[numbers]
    rolled = single
    for k in range(2, ORDER + 1):
        rolled = rolled[:-1] * _STEP + single[k - 1:]
        mixed = (rolled ^ (rolled >> np.uint64(32))) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
        yield mixed >> np.uint64(64 - HASH_BITS), piece[k - 1:] == piece[:len(rolled)]


def pack(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane, and their counts."""
    apart = np.diff(values, prepend=np.uint64(0))
    planes = max(1, (int(apart.max()).bit_length() + 7) // 8)
    bytes_ = apart.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + np.ascontiguousarray(bytes_.T).tobytes() + counts.tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = packed[0]
    data = np.frombuffer(packed, np.uint8, offset=1).reshape(planes + 1, -1)
    apart = np.zeros((data.shape[1], 8), np.uint8)
    apart[:, :planes] = data[:planes].T
    return np.cumsum(apart.view("<u8").ravel(), dtype=np.uint64), data[planes]


def added(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and the sums of their counts."""
    if counts is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    sums = np.diff(np.append(first, len(values))) if counts is None else np.add.reduceat(counts, first)
    return values[first], sums


def frequent_bitmap(plain: DataFrame, least: int) -> np.ndarray:
    """Bits of the hashes of phrases with ``least`` occurrences or more, as bytes."""
    # Counts travel as one byte each, so a higher ``least`` pads as if it were 255.
    least = min(least, 255)
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = min(max(4, (size // PART).bit_length()), 16)
    shift = np.uint64(HASH_BITS - part_bits)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("packed", T.BinaryType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for lang, block in blocks(batches):
            numbers, words, piece = words_of(block)
            values = [h[whole] for h, whole in phrase_hashes(lang, numbers, words, piece)]
            values, counts = added(np.concatenate(values))
            counts = np.minimum(counts, least).astype(np.uint8)
            bounds = np.searchsorted(values, np.arange(1 << part_bits, dtype=np.uint64) << shift)
            bounds = np.append(bounds, len(values))
            used = np.flatnonzero(np.diff(bounds))
            yield {"part": used, "packed": [
                pack(values[bounds[p]:bounds[p + 1]] - (np.uint64(p) << shift), counts[bounds[p]:bounds[p + 1]]) for p in used]}

    width = 1 << (MAP_BITS - part_bits)

    def add_up(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        pieces = [unpack(p) for p in group["packed"].to_pylist()]
        values, counts = added(np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces]))
        bits = np.zeros(width, np.uint8)
        bits[values[counts >= least] >> np.uint64(HASH_BITS - MAP_BITS)] = 1
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "packed": pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())})

    bitmap = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    sent = rows_by_batch(plain, schema, make).repartition(1 << part_bits, "part")
    for r in sent.groupBy("part").applyInArrow(add_up, schema).collect():
        bits = np.frombuffer(zlib.decompress(r.packed), np.uint8)
        bitmap[r.part * len(bits):(r.part + 1) * len(bits)] = bits
    return bitmap


def longest_windows(plain: DataFrame, bitmap) -> DataFrame:
    """(lang, w1, w2, w3, w4, n): counts of the padded windows, a block of text at a time."""
    names = ["w1", "w2", "w3", "w4"]
    schema = T.StructType([T.StructField("lang", T.StringType()), *[T.StructField(w, T.BinaryType()) for w in names],
                           T.StructField("n", T.LongType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for lang, block in blocks(batches):
            numbers, words, piece = words_of(block)
            if not len(numbers):
                continue
            bits = bitmap.value
            length = np.ones(len(numbers), np.int8)
            for k, (hashed, whole) in enumerate(phrase_hashes(lang, numbers, words, piece), 2):
                open_ = np.flatnonzero(whole & (length[:len(whole)] == k - 1))
                spot = hashed[open_] >> np.uint64(HASH_BITS - MAP_BITS)
                hit = (bits[spot >> np.uint64(3)] >> (np.uint64(7) - (spot & np.uint64(7))).astype(np.uint8)) & 1
                length[open_[hit == 1]] = k
            alone = np.bincount(numbers[length == 1], minlength=len(words))
            seen = np.flatnonzero(alone)
            lead = np.flatnonzero(length > 1)
            pad = len(words)
            columns = [numbers[lead].astype(np.int64)]
            for k in range(1, ORDER):
                at = np.minimum(lead + k, len(numbers) - 1)
                columns.append(np.where(length[lead] > k, numbers[at], pad).astype(np.int64))
            # Pairs of words, then pairs of pairs, are numbered exactly.
            front, front_at = np.unique(columns[0] * (pad + 1) + columns[1], return_inverse=True)
            back, back_at = np.unique(columns[2] * (pad + 1) + columns[3], return_inverse=True)
            windows, counts = np.unique(front_at * max(1, len(back)) + back_at, return_counts=True)
            front, back = front[windows // max(1, len(back))], back[windows % max(1, len(back))]
            chosen = [np.concatenate([part, fill]) for part, fill in (
                (front // (pad + 1), seen), (front % (pad + 1), np.full(len(seen), pad)),
                (back // (pad + 1), np.full(len(seen), pad)), (back % (pad + 1), np.full(len(seen), pad)))]
            spelt = pa.concat_arrays([words, pa.array([b""], pa.large_binary())]).cast(pa.binary())
            counts = np.concatenate([counts, alone[seen]])
            for at in range(0, len(counts), 1 << 17):
                cut = slice(at, at + (1 << 17))
                yield {"lang": pa.array([lang] * len(counts[cut])), "n": counts[cut],
                       **{w: spelt.take(pa.array(c[cut])) for w, c in zip(names, chosen)}}

    return rows_by_batch(plain, schema, make)


def phrase_counts(docs: DataFrame, least: int, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, k, phrase, f): occurrences of the phrases of k words with ``least`` or more, and of all words as k = 0."""
    plain = docs.select(F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        column(text_col).cast("string").alias("text")).where("text is not null")
    bitmap = docs.sparkSession.sparkContext.broadcast(frequent_bitmap(plain, least))
    names = ["w1", "w2", "w3", "w4"]
    windows = longest_windows(plain, bitmap).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    rolled = windows.select("lang", *[F.col(w).cast("string").alias(w) for w in names], "n").rollup("lang", *names).agg(
        F.sum("n").alias("f"), F.grouping_id().alias("gone"))
    # Words that the rollup has left out are NULL, padding is empty.
    k = F.when(F.col("gone") == 0, 4).when(F.col("gone") == 1, 3).when(F.col("gone") == 3, 2).when(F.col("gone") == 7, 1).otherwise(0)
    last = F.coalesce(*reversed(names))
    kept = rolled.withColumn("k", k).where("gone < 31").where((F.col("k") == 0) | ((last != "") & (F.col("f") >= least)))
    counted = staged(kept.select("lang", "k", F.concat_ws(" ", *names).alias("phrase"), "f"), "phrase-counts")
    bitmap.destroy()
    return counted


def collocations(
    docs: DataFrame, *, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of 2 to 4 words of each language.

    The score of a phrase is that of its weakest cut in two, 2000000 a / (l + r) rounded down, with
    a its own count, l and r those of the two parts.  A phrase inside a longer one with at least 80
    percent of its count gives way to it.
    """
    counts = phrase_counts(docs, least, text_col=text_col, lang_col=lang_col)
    grams = counts.where("k > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))
    known = counts.where("k > 0")

    def piece(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    cuts = grams.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "k", "phrase", "a", "cut", piece(F.lit(1), F.col("cut")).alias("first"),
                       piece(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    both = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # Decimals hold the product where 64 bits do not.
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0))) div cast(l + r as decimal(20, 0))")
    scored = both.select("lang", "phrase", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("s")).groupBy(
        "lang", "phrase", "a").agg(F.min("s").alias("s"))
    inner = F.when(F.col("k") == 3, F.array(piece(F.lit(1), F.lit(2)), piece(F.lit(2), F.lit(2)))).otherwise(F.array(
        *[piece(F.lit(i), F.lit(n)) for n in (2, 3) for i in range(1, 6 - n)]))
    longer = grams.where("k > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).groupBy(
        "lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        "longer is null or cast(100 as decimal(3, 0)) * cast(longer as decimal(19, 0)) "
        "< cast(80 as decimal(3, 0)) * cast(a as decimal(19, 0))")
    order = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "s.l", "s.r", "n", "s.score")
