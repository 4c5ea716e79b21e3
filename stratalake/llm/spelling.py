"""Groups of spelling variants: words one edit apart, by bidirectional FM-indexes.

The vocabulary is cut into shards of bounded size.  A shard's words, parted by delimiters, are one
text with two indexes, one over the text and one over its reverse.  An interval of suffix ranks in
one and its twin in the other stand for the places of a string, which can grow at both ends.

A word one edit away has either the half before or the half behind the edit unchanged, so there
are two searches.  Each matches one half exactly, outwards up to the word's delimiter, and then turns
and extends over the other half in the twin index, allowing one inserted, deleted or replaced code
point, up to the other delimiter.

A word is sent only to shards of words with its half: as a query with its own first and last half,
and as an entry with the halves that words of its length and one more or less can have.  A half of
more than ``SHARD`` entries is dealt over several shards, each of which meets each part of the
queries with that half, so no task holds more than about ``SHARD`` entries and as many queries.

NULL texts have no words; a NULL id counts as no digits.  A repeated row counts again.  An empty
table gives an empty result.  Words of any length are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import column, rows_by_batch, utf8
from stratalake.session import staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST, LEAST, RATIO = 6, 5, 5
# Entries of an index, give or take the chance of hashing.
SHARD = 8192
# Distinct words whose counts a task holds before it hands them on.
HELD = 200_000
# Symbols between two stored counts of an index.
STRIDE = 16

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slipped(word: str, start: int) -> str:
    """``word``, or without one code point if 199 divides its hash, which continues from ``start``."""
    h = zlib.crc32(word.encode(), start)
    if h % 199:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of ``SHORTEST`` code points or more with ``LEAST`` occurrences or more."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    plain = docs.select(F.coalesce(column(id_col).cast("string"), F.lit("")).alias("id"),
                        column(text_col).cast("string").alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), utf8(batch, "text")):
                start = zlib.crc32(f"{name}:".encode())
                runs = Counter(RUN.findall(text.decode("utf-8", "replace").translate(_LOWER)))
                for run, n in runs.items():
                    if len(run) >= SHORTEST:
                        word = slipped(run, start)
                        if len(word) >= SHORTEST:
                            held[word] += n
                if len(held) >= HELD:
                    yield {"word": list(held), "n": list(held.values())}
                    held = Counter()
        yield {"word": list(held), "n": list(held.values())}

    return rows_by_batch(plain, schema, make).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the length that ranks stand for."""
    size = len(text)
    rank = text.astype(np.int64)
    length = 1
    while True:
        behind = np.zeros(size, np.int64)
        behind[:max(0, size - length)] = rank[length:] + 1
        key = rank * (size + 2 + int(text.max(initial=0))) + behind
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(size, np.int64)
        rank[order] = steps
        if steps[-1] == size - 1 or length >= size:
            return order
        length *= 2


class Ranks:
    """One direction of an index: counts of smaller symbols before any place of the transform."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.order = suffix_order(text)
        moved = text[self.order - 1].astype(np.uint8)
        self.size, self.symbols = len(text), symbols
        stored = -(-(self.size + 1) // STRIDE)
        self.near = np.full((stored, STRIDE), 255, np.uint8)
        self.near.ravel()[:self.size] = moved
        steps = np.zeros((stored + 1, symbols + 1), np.int32)
        place = np.arange(self.size) // STRIDE
        np.add.at(steps, (place + 1, moved.astype(np.int64) + 1), 1)
        # Sums over symbols, then over places: symbols smaller than c before a stored place.
        self.less = np.cumsum(np.cumsum(steps, axis=1), axis=0, dtype=np.int32)
        self.begins = self.less[-1]

    def smaller(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Symbols less than ``symbol`` before ``place``."""
        stored = place // STRIDE
        near = (self.near[stored] < symbol[:, None]) & (np.arange(STRIDE) < (place % STRIDE)[:, None])
        return self.less[stored, symbol] + near.sum(axis=1)

    def smaller_of_all(self, place: np.ndarray) -> np.ndarray:
        """As ``smaller`` for every symbol, a column each, and one past the last."""
        stored = place // STRIDE
        out = self.less[stored].astype(np.int64)
        within = np.arange(STRIDE) < (place % STRIDE)[:, None]
        for c in range(1, self.symbols + 1):
            out[:, c] += ((self.near[stored] < c) & within).sum(axis=1)
        return out

    def grow(self, symbol: np.ndarray, low: np.ndarray, size: np.ndarray, twin: np.ndarray | None = None):
        """Intervals of the strings with ``symbol`` put to their end, and those of the twin index."""
        first, last = self.smaller(symbol, low), self.smaller(symbol, low + size)
        up, top = self.smaller(symbol + 1, low), self.smaller(symbol + 1, low + size)
        grown = self.begins[symbol] + up - first
        return grown, (top - last) - (up - first), None if twin is None else twin + last - first

    def grow_by_any(self, low: np.ndarray, size: np.ndarray):
        """(place among the given, symbol, low, size) of every string with any letter put to its end."""
        at, symbol, lows, sizes = [], [], [], []
        for cut in range(0, len(low), 4096):
            before = self.smaller_of_all(low[cut:cut + 4096])
            behind = self.smaller_of_all(low[cut:cut + 4096] + size[cut:cut + 4096])
            counts = np.diff(behind, axis=1) - np.diff(before, axis=1)
            row, c = np.nonzero(counts[:, 1:])
            c += 1
            at.append(row + cut)
            symbol.append(c)
            lows.append(self.begins[c] + before[row, c + 1] - before[row, c])
            sizes.append(counts[row, c])
        if not at:
            return (np.empty(0, np.int64),) * 4
        return tuple(np.concatenate(x) for x in (at, symbol, lows, sizes))


class Shard:
    """Distinct words as one delimited text with an index in each direction."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        letters = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))
        # The delimiter is symbol 0, letters follow in code-point order.
        self.letters = letters
        sizes = np.array([len(w) for w in words])
        text = np.zeros(int(sizes.sum()) + len(words) + 1, np.int64)
        ends = np.cumsum(sizes + 1)
        solid = np.ones(len(text), bool)
        solid[0] = False
        solid[ends] = False
        text[solid] = np.searchsorted(letters, np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)) + 1
        symbols = len(letters) + 1
        self.starts = np.concatenate([[0], ends[:-1]])
        self.size = len(text)
        # Backwards extends a string at its front, forwards at its end.
        self.backwards, self.forwards = Ranks(text, symbols), Ranks(text[::-1], symbols)

    def coded(self, words: list[str]) -> np.ndarray:
        """Symbols of words of one length, a row each; -1 where no entry has the letter."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 1, -1).astype(np.int64)

    def one_edit(self, words: list[str], front: bool) -> Iterator[tuple[int, int]]:
        """(place in ``words``, number of an entry) of entries one edit away whose half is unchanged.

        The half is the first one with ``front``, else the last.  The words have one length.
        """
        codes = self.coded(words)
        half = codes.shape[1] // 2
        if front:
            exact, rest = codes[:, :half][:, ::-1], codes[:, half:]
            first, turned = self.backwards, self.forwards
        else:
            exact, rest = codes[:, half:], codes[:, :half][:, ::-1]
            first, turned = self.forwards, self.backwards
        query = np.arange(len(words))
        low, size, twin = np.zeros(len(words), np.int64), np.full(len(words), self.size), np.zeros(len(words), np.int64)
        for j in range(exact.shape[1] + 1):
            symbol = exact[query, j] if j < exact.shape[1] else np.zeros(len(query), np.int64)
            known = symbol >= 0
            query = query[known]
            low, size, twin = first.grow(symbol[known], low[known], size[known], twin[known])
            found = size > 0
            query, low, size, twin = query[found], low[found], size[found], twin[found]
        # From here on the strings grow at the other end, in the other index.
        clean = (query, twin, size)
        edited = tuple(np.empty(0, np.int64) for _ in range(3))

        def joined(*states):
            return tuple(np.concatenate(parts) for parts in zip(*states))

        def step(state, symbol):
            known = symbol >= 0
            who, low, size = (x[known] for x in state)
            low, size, _ = turned.grow(symbol[known], low, size)
            found = size > 0
            return who[found], low[found], size[found]

        for j in range(rest.shape[1] + 1):
            at, letter, lows, sizes = turned.grow_by_any(clean[1], clean[2])
            grown = (clean[0][at], lows, sizes)
            edited = joined(edited, grown)
            if j == rest.shape[1]:
                break
            wanted = rest[:, j]
            replaced = letter != wanted[grown[0]]
            edited = joined(step(edited, wanted[edited[0]]), clean, tuple(x[replaced] for x in grown))
            clean = step(clean, wanted[clean[0]])
        who, low, size = step(edited, np.zeros(len(edited[0]), np.int64))
        place = turned.order[low]
        if front:
            # Places in the reversed text are those of the closing delimiter.
            number = np.searchsorted(self.starts, self.size - 1 - place, side="left") - 1
        else:
            number = np.searchsorted(self.starts, place, side="right") - 1
        return sorted(set(zip(who.tolist(), number.tolist())))


def halves(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(front, half, word, n) of entries, with every half that a near word can have, and of queries."""
    size = F.char_length("word")

    def front(length):
        return F.expr(f"substring(word, 1, ({length}) div 2)")

    def back(length):
        return F.expr(f"right(word, ({length}) - ({length}) div 2)")

    lengths = ["char_length(word) - 1", "char_length(word)", "char_length(word) + 1"]
    sides = [(True, front), (False, back)]
    entries = words.select("word", "n", F.explode(F.array_distinct(F.array(*[
        F.struct(F.lit(is_front).alias("front"), make(length).alias("half")) for is_front, make in sides for length in lengths
    ]))).alias("h")).where(size >= SHORTEST)
    queries = words.select("word", "n", F.explode(F.array(*[
        F.struct(F.lit(is_front).alias("front"), make(lengths[1]).alias("half")) for is_front, make in sides])).alias("h"))
    return tuple(df.select("h.front", "h.half", "word", "n") for df in (entries, queries))


def near_words(words: DataFrame, count: int) -> DataFrame:
    """(word, near, near_n): each pair of words one edit apart, from both sides; pairs may repeat."""
    entries, queries = halves(words)
    # Only halves with more entries than a shard holds: at most a four-thousandth as many as words.
    crowded = entries.groupBy("front", "half").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > SHARD).select(
        "front", "half", F.ceil(F.col("c") / SHARD).cast("int").alias("splits"))

    def dealt(df: DataFrame, own: str, others: str) -> DataFrame:
        split = df.join(crowded, ["front", "half"], "left").withColumn("splits", F.coalesce("splits", F.lit(1)))
        return split.withColumn(own, F.pmod(F.xxhash64("word", F.lit(own)), F.col("splits").cast("long")).cast("int")).withColumn(
            others, F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))

    shards = max(1, -(-2 * count // SHARD))
    both = dealt(entries, "e", "q").withColumn("asks", F.lit(False)).unionByName(
        dealt(queries, "q", "e").withColumn("asks", F.lit(True)))
    placed = both.select("front", F.pmod(F.xxhash64("half", "e", "q"), F.lit(shards)).alias("shard"), "word", "n", "asks")
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("near", T.StringType()),
                           T.StructField("near_n", T.LongType())])

    def search(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        front = key[0].as_py()
        asks = group["asks"].to_numpy()
        words, counts = np.array(group["word"].to_pylist(), object), group["n"].to_numpy()
        known = dict(zip(words[~asks], counts[~asks].tolist()))
        out = {"word": [], "near": [], "near_n": []}
        if known and asks.any():
            shard = Shard(sorted(known))
            by_length: dict[int, set[str]] = {}
            for word in words[asks]:
                by_length.setdefault(len(word), set()).add(word)
            for asked in map(sorted, by_length.values()):
                for at, number in shard.one_edit(asked, front):
                    near = shard.words[number]
                    out["word"].append(asked[at])
                    out["near"].append(near)
                    out["near_n"].append(known[near])
        return pa.table({"word": pa.array(out["word"], pa.string()), "near": pa.array(out["near"], pa.string()),
                         "near_n": pa.array(out["near_n"], pa.int64())})

    # Few bytes, much work: a number of tasks of their own, which are not merged by size.
    return placed.repartition(shards, "front", "shard").groupBy("front", "shard").applyInArrow(search, schema)


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary.

    ``form`` is the near word of most occurrences, the smallest of these, if it has ``RATIO`` times
    those of the word.  ``root`` is where the forms of forms end.
    """
    words = staged(vocabulary(docs, id_col=id_col, text_col=text_col), "spelling-words")
    count, most = words.agg(F.count(F.lit(1)), F.max("n")).first()
    pairs = near_words(words, count).distinct()
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("fewer"), "near")).alias("best"))
    enough = -F.col("best.fewer") >= RATIO * F.col("n")
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.fewer")).alias("form_n"))
    known = staged(known, "spelling-forms")
    # Each form has RATIO times the occurrences, which bounds the length of a chain; a round doubles it.
    roots = known.where("form is not null").select("word", F.col("form").alias("root"))
    reach, longest = 1, 0
    while RATIO ** (longest + 1) * LEAST <= (most or 0):
        longest += 1
    while reach < longest:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = staged(roots.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "spelling-roots")
        reach *= 2
    return known.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
