"""Benchmark decontamination by Wu-Manber search over words.

The alphabet is words, a pattern is a window of ten consecutive words of a
benchmark item, or all words of a shorter item.  Patterns of one length share a
searcher: a shift table over blocks of two words says how far the search may
jump, the block that ends a pattern names a bucket of patterns, the first words
of each are checked, and a comparison of all words confirms.

Documents are never shuffled.  The patterns of a benchmark are counted first:
up to ``max_patterns`` they are one set that every task gets; a larger benchmark
is split by hash into sets of that size, which are searched one after another.

NULL texts and texts without words are clean; an item without words has no
pattern.  Items that share an id count once, an item without an id is listed as
``null``.  Columns that are neither id nor text are passed through or ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import append_by_batch, column, fresh, rows_by_batch, utf8

WINDOW = 10
MAX_PATTERNS = 200_000

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])

# One byte per byte: A-Z to lower case, everything that is no word byte to a blank.
_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_LOWER = bytes(range(256)).lower()
_FOLD = bytes(_LOWER[b] if _LOWER[b] in _KEEP else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return text.translate(_FOLD).split()


class WuManber:
    """Searcher for patterns of one length, in words."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], length: int):
        self.length = length
        self.block = block = min(2, length)
        self.jump = length - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(block, length + 1):
                part = pattern[end - block:end]
                self.shift[part] = min(self.shift.get(part, self.jump), length - end)
            self.buckets[pattern[length - block:]].append((pattern[0], pattern, items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(first word, items) of every occurrence, from left to right."""
        length, block, jump, shift = self.length, self.block, self.jump, self.shift
        end, size = length, len(words)
        while end <= size:
            part = tuple(words[end - block:end])
            step = shift.get(part, jump)
            if step:
                end += step
                continue
            start = end - length
            for first, pattern, items in self.buckets[part]:
                if first == words[start] and pattern == tuple(words[start:end]):
                    yield start, items
            end += 1


def benchmark_patterns(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(words joined by blanks, item) for every window of every item."""
    schema = T.StructType([T.StructField("pattern", T.BinaryType()),
                           T.StructField("item", T.StringType())])

    def windows(batches):
        for batch in batches:
            patterns, owners = [], []
            for item, text in zip(batch.column(1).to_pylist(), utf8(batch, "text")):
                words = words_of(text)
                size = min(window, len(words))
                found = {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if size else ()
                patterns += found
                owners += ["null" if item is None else item] * len(found)
            yield {"pattern": patterns, "item": owners}

    items = benchmark.select(column(text_col).cast("string").alias("text"),
                             column(id_col).cast("string").alias("item"))
    return rows_by_batch(items, schema, windows).distinct()


def searchers(pairs: list[tuple[bytes, str]]) -> list[WuManber]:
    """One searcher for each pattern length."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for pattern, item in pairs:
        words = tuple(pattern.split(b" "))
        by_length[len(words)][words].append(item)
    return [WuManber(patterns, length) for length, patterns in sorted(by_length.items())]


def mark(words: list[bytes], machines: list[WuManber], known: dict | None = None) -> dict:
    """Hit words as spans, and items, of one document; ``known`` are hits found before."""
    hit, items = bytearray(len(words)), set()
    if known:
        items.update(known["items"])
        for span in known["spans"]:
            hit[span["first_word"]:span["first_word"] + span["words"]] = b"\1" * span["words"]
    for machine in machines:
        ones = b"\1" * machine.length
        for start, owners in machine.find(words):
            hit[start:start + machine.length] = ones
            items.update(owners)
    spans, at = [], hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        spans.append({"first_word": at, "words": end - at})
        at = hit.find(1, end)
    return {"n_words": len(words), "n_hit": sum(s["words"] for s in spans), "spans": spans,
            "items": sorted(items)}


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, name: str = "hits", *, text_col: str = "text",
    item_col: str = "item_id", window: int = WINDOW, max_patterns: int = MAX_PATTERNS,
) -> DataFrame:
    """``docs`` with a column ``name``: words, hit words, hit spans and items (``HITS``)."""
    patterns = benchmark_patterns(benchmark, item_col, "text", window)
    sets = max(1, math.ceil(patterns.count() / max_patterns))
    context = docs.sparkSession.sparkContext
    kept, text = list(docs.columns), fresh(docs, "folded_text")
    found = docs.withColumn(text, column(text_col).cast("string"))
    for part in range(sets):
        some = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(sets)) == part)
        handed = context.broadcast([(bytes(r[0]), r[1]) for r in some.collect()])
        found = _search(found, handed, text, fresh(found, name), None if part == 0 else last)
        last = found.columns[-1]
    return found.select(*[column(c) for c in kept], column(last).alias(name))


def _search(docs: DataFrame, handed, text: str, name: str, before: str | None) -> DataFrame:
    made: list[WuManber] = []

    def run(batch: pa.RecordBatch) -> list[dict]:
        if not made:
            made.extend(searchers(handed.value) or [WuManber({}, 1)])
        known = batch.column(batch.schema.get_field_index(before)).to_pylist() if before else None
        return [mark(words_of(t), made, known[i] if known else None)
                for i, t in enumerate(utf8(batch, text))]

    return append_by_batch(docs, name, HITS, run)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns."""
    name = fresh(docs, "hits")
    found = find_contamination(docs, benchmark, name, **options)
    return found.where(column(name)["n_hit"] == 0).drop(name)
