"""Repeated byte strings, found by refining buckets of windows.

Every window of 200 bytes is put into a bucket by its least q-gram (the q-gram of
least hash among those in the window), so equal windows share a bucket whatever
surrounds them.  Neighbouring windows mostly share theirs, at one place, so a run of
them is one row.  No suffixes are ordered and no bucket pointers are followed: this
replaces bucket-pointer refinement, whose suffixes would be a row for each byte.  A
bucket is refined by hashes:

* the run's whole text: equal runs are repeated, all of their windows;
* a deeper q-gram, for the windows of runs that are still alone in a bucket of
  several; what a depth decides is used again by the next one, which only sees
  the rest.  The last depth is the window itself.

Windows that are decided stay as witnesses for the rest of their bucket, one for
each different run.  A bucket with one member is done: its windows are unique.

Per task, equal rows are found before the shuffle: a task asks about a bucket
once, or tells that it knows it to be repeated, so a bucket has at most as many
rows as there are tasks, however many copies the corpus has.  Texts are shuffled
once; documents that are decided then leave, and the others carry on with
snippets around what is open.  Identifiers are 64-bit hashes; a removal needs two
that agree.

NULL and empty texts have nothing to remove, nor have texts below 200 bytes.
Equal rows count as different places, so their long texts go entirely.  An empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import column, rows_by_batch, utf8
from stratalake.session import staged

LENGTH = 200
DEPTHS = (100, 168, 200)
# Bytes hashed at a time, and rows that a task gathers before it looks for equal ones.
PIECE = 1 << 18
GATHER = 300_000

# A place: 24 bits that tell documents of one hash apart, first byte, windows - 1.
_LO, _TAG = 8, 39
_LO_MASK = (1 << (_TAG - _LO)) - 1

ROW = T.StructType([T.StructField(n, T.LongType()) for n in (
    "part", "bucket", "run", "ref", "place")] + [
    T.StructField("asks", T.BooleanType()), T.StructField("n", T.LongType())])
STEP = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("doc_id", T.LongType()),
    T.StructField("ref", T.LongType()), T.StructField("text", T.BinaryType()),
    T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("place", T.LongType()), T.StructField("asks", T.BooleanType()),
    T.StructField("n_bytes", T.LongType()), T.StructField("kept_sha256", T.StringType())])


KINDS = ["found", "open", "witness"]
# Low bits that hold the place of a q-gram in a buffer.
_PLACES = np.uint64((1 << 20) - 1)


class Rolling:
    """Polynomial hashes modulo 2^64 of all substrings of a buffer, by prefix sums."""

    def __init__(self, seed: int):
        random = np.random.Generator(np.random.PCG64(seed))
        self.codes = random.integers(1, 1 << 63, 256, dtype=np.uint64)
        base = int(random.integers(1, 1 << 62)) * 8 + 5
        self.up = self._powers(base)
        self.down = self._powers(pow(base, -1, 1 << 64))

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        out, have, step = np.ones(2 * PIECE + 1024, np.uint64), 1, base
        while have < len(out):
            more = min(have, len(out) - have)
            out[have:have + more] = out[:more] * np.uint64(step)
            have, step = have + more, step * step % (1 << 64)
        return out

    def sums(self, data: np.ndarray) -> np.ndarray:
        held = np.empty(len(data) + 1, np.uint64)
        held[0] = 0
        np.cumsum(self.codes[data] * self.up[:len(data)], out=held[1:])
        return held

    def hashes(self, sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        return scramble((sums[start + length] - sums[start]) * self.down[start])

    def grams(self, sums: np.ndarray, size: int) -> np.ndarray:
        return scramble((sums[size:] - sums[:-size]) * self.down[:len(sums) - size])


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_made: dict[int, Rolling] = {}


def rolling(seed: int) -> Rolling:
    if seed not in _made:
        _made[seed] = Rolling(seed)
    return _made[seed]


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - span:]) if span < width else out


def runs(regions: list[tuple[int, int, bytes]], depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(region, first byte there, windows - 1, bucket, run hash) of each run of windows.

    A region is (number, offset, bytes); its windows are those inside it.  Equal windows are
    never in one run, as a run has one place of its q-gram.
    """
    held, size = [], 0
    for region in regions:
        held.append(region)
        size += len(region[2])
        if size >= PIECE:
            yield _runs(held, depth)
            held, size = [], 0
    if held:
        yield _runs(held, depth)


def _runs(regions: list[tuple[int, int, bytes]], depth: int) -> tuple[np.ndarray, ...]:
    first, second = rolling(1), rolling(2)
    sizes = np.array([len(r[2]) for r in regions])
    data = np.frombuffer(b"".join(r[2] for r in regions), np.uint8)
    sums = first.sums(data)
    grams = first.grams(sums, depth)
    # Least by the upper bits, the first of equals: its place tells repeated ones apart.
    places = np.arange(len(grams), dtype=np.uint64)
    chosen = least_of((grams & ~_PLACES) | places, LENGTH - depth + 1) & _PLACES
    owner = np.repeat(np.arange(len(regions)), sizes)[:len(chosen)]
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    inside = np.arange(len(chosen)) - begins[owner]
    valid = inside + LENGTH <= sizes[owner]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new & valid)
    # A run ends where the next begins, or with the last window of its region.
    ends = np.append(np.flatnonzero(new), len(chosen))
    end = ends[np.searchsorted(ends, start, "right")]
    end = np.minimum(end, begins[owner[start]] + sizes[owner[start]] - LENGTH + 1)
    windows = end - start
    run = second.hashes(second.sums(data), start, windows + LENGTH - 1) + windows.astype(np.uint64)
    number = np.array([r[0] for r in regions])[owner[start]]
    offset = np.array([r[1] for r in regions])[owner[start]] + inside[start]
    return number, offset, windows - 1, grams[chosen[start].astype(np.int64)], run


def regions_of(number: int, text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """A text as regions that share no window and leave out none."""
    for at in range(0, max(0, len(text) - LENGTH + 1), PIECE):
        yield number, at, text[at:at + PIECE + LENGTH - 1]


def tag_of(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=3).digest(), "big")


def questions(bucket, run, ref, place, asks, by_run: bool) -> dict:
    """Rows to shuffle: each bucket that a task knows once is asked about; others are known.

    Known rows go anywhere (``part``); one row tells how many they are.
    """
    order = np.lexsort((run, bucket)) if by_run else np.argsort(bucket, kind="stable")
    bucket, run, ref, place, asks = (x[order] for x in (bucket, run, ref, place, asks))
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    if by_run:
        new[1:] |= run[1:] != run[:-1]
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(bucket)))
    known = np.repeat(counts > 1, counts)
    part = np.where(known, scramble(ref.view(np.uint64) ^ (place.view(np.uint64) << np.uint64(7))), bucket)
    told = heads[counts > 1]
    zeros = np.zeros(len(told), np.int64)
    join = np.concatenate
    return {
        "part": join([part, bucket[told]]).view(np.int64),
        "bucket": join([bucket, bucket[told]]).view(np.int64),
        "run": join([run, run[told]]).view(np.int64),
        "ref": join([ref, zeros]), "place": join([place, zeros - 1]),
        "asks": join([asks, np.zeros(len(told), bool)]),
        "n": join([np.where(known, 0, 1), counts[counts > 1]]),
    }


def collect_runs(pieces: Iterator[tuple], by_run: bool) -> Iterator[dict]:
    """``questions`` over all that a task finds, a bounded number of rows at a time."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[0])
        if size >= GATHER:
            yield questions(*map(np.concatenate, zip(*held)), by_run)
            held, size = [], 0
    if held:
        yield questions(*map(np.concatenate, zip(*held)), by_run)


def repeated_rows(rows: DataFrame, by_run: bool) -> DataFrame:
    """(bucket, run, ref, place, asks) of rows whose bucket has several members."""
    members = Window.partitionBy("part", "run") if by_run else Window.partitionBy("part")
    return rows.withColumn("total", F.sum("n").over(members)).where(
        "place >= 0 and (n = 0 or total > 1)").select("bucket", "run", "ref", "place", "asks")


def open_runs(members: DataFrame) -> DataFrame:
    """(ref, place, asks): runs to be looked at more closely, and their witnesses."""
    each = members.groupBy("bucket", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("ref", "place", "asks")).alias("one"))
    wanting = (F.col("n") == 1) & F.col("one.asks")
    buckets = each.groupBy("bucket").agg(
        F.sum("n").alias("total"), F.max(wanting.cast("int")).alias("wanting")).where("total > 1 and wanting = 1")
    return each.join(buckets.select("bucket"), "bucket").select(
        "one.ref", "one.place", wanting.alias("asks"))


def by_document(rows: DataFrame, kinds: list[str]) -> DataFrame:
    """Places of each kind in each document, named ``mark_ref``: bounded by its length."""
    return rows.groupBy(F.col("ref").alias("mark_ref")).agg(*[
        F.collect_set(F.when(F.col("kind") == kind, F.col("place"))).alias(kind) for kind in kinds])


def picked(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Columns of a batch as lists."""
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def mine(places, tag: int) -> list[int]:
    """Places of a document's own, without the tag."""
    return [p & ((1 << _TAG) - 1) for p in places or () if p >> _TAG == tag]


def merged(places: list[int]) -> list[tuple[int, int]]:
    """Bytes covered by the windows, as maximal runs."""
    out: list[list[int]] = []
    for place in sorted(places):
        start = place >> _LO
        end = start + (place & ((1 << _LO) - 1)) + LENGTH
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans."""
    at, left = 0, []
    for start, end in spans:
        left.append(text[at:start])
        at = end
    return b"".join([*left, text[at:]])


def _row(**values) -> dict:
    return dict.fromkeys(STEP.names) | values


def _finished(doc_id, text: bytes, places: list[int], keep_text: bool) -> dict:
    spans = merged(places)
    kept = cut(text, spans)
    return _row(kind="done", doc_id=doc_id, starts=[s for s, _ in spans], ends=[e for _, e in spans],
                n_bytes=len(text), kept_sha256=hashlib.sha256(kept).hexdigest(),
                text=kept if keep_text else None)


def _flat(rows: list[dict]) -> dict:
    return {n: [r[n] for r in rows] for n in STEP.names}


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, removed ``starts`` and ``ends``, kept_sha256, kept ``text``.

    Without ``keep_text`` the remaining bytes are hashed and left out.
    """
    plain = docs.select(column(id_col).cast("long").alias("doc_id"),
                        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    refs = plain.withColumn("ref", F.xxhash64("doc_id", "text"))

    def first_runs(batches):
        def found():
            for batch in batches:
                texts = utf8(batch, "text")
                refs_ = batch.column(batch.schema.get_field_index("ref")).to_numpy()
                tags = np.array([tag_of(t) for t in texts], np.int64)
                regions = (r for i, t in enumerate(texts) for r in regions_of(i, t))
                for number, offset, windows, bucket, run in runs(regions, DEPTHS[0]):
                    place = tags[number] << _TAG | offset << _LO | windows
                    yield bucket, run, refs_[number], place, np.ones(len(place), bool)
        yield from collect_runs(found(), False)

    members = staged(repeated_rows(rows_by_batch(refs.select("ref", "text"), ROW, first_runs), False), "repeats-0")
    looked = staged(open_runs(members), "repeats-open-0")
    marks = members.select("ref", "place", F.lit("found").alias("kind")).unionByName(
        looked.select("ref", "place", F.when(F.col("asks"), "open").otherwise("witness").alias("kind")))

    def decide(batches):
        for batch in batches:
            rows, held = [], 0
            for text, doc_id, ref, *places in zip(
                    utf8(batch, "text"), *picked(batch, "doc_id", "ref", "found", "open", "witness")):
                tag = tag_of(text)
                found, wanted, witness = (mine(p, tag) for p in places)
                for asks, places in ((True, wanted), (False, witness)):
                    for p in places:
                        lo, more = p >> _LO, p & ((1 << _LO) - 1)
                        rows.append(_row(kind="part", ref=ref, place=tag << _TAG | p, asks=asks,
                                         text=text[lo:lo + more + LENGTH]))
                repeated = list(set(found).difference(wanted))
                if wanted:
                    spans = merged(repeated)
                    rows.append(_row(kind="open", doc_id=doc_id, ref=ref, text=text,
                                     starts=[s for s, _ in spans], ends=[e for _, e in spans]))
                else:
                    rows.append(_finished(doc_id, text, repeated, keep_text))
                held += len(text)
                if held > 8 << 20:
                    yield _flat(rows)
                    rows, held = [], 0
            yield _flat(rows)

    joined = refs.join(by_document(marks, KINDS), F.col("ref") == F.col("mark_ref"), "left").drop("mark_ref")
    step = staged(rows_by_batch(joined, STEP, decide), "repeats-step")
    parts = step.where("kind = 'part'").select("ref", "place", "asks", "text")
    found, kinds = [], []
    for depth in DEPTHS[1:]:
        last = depth == LENGTH
        members = staged(repeated_rows(rows_by_batch(
            parts.select("ref", "place", "asks", "text"), ROW, _part_runs(depth)), last), f"repeats-{depth}")
        kinds += [f"found_{depth}", f"open_{depth}"]
        found.append(members.where("asks").select("ref", "place", F.lit(kinds[-2]).alias("kind")))
        if not last:
            looked = staged(open_runs(members), f"repeats-open-{depth}")
            found.append(looked.where("asks").select("ref", "place", F.lit(kinds[-1]).alias("kind")))
            parts = staged(_smaller_parts(parts, looked), f"repeats-parts-{depth}")
    marks = found[0]
    for more in found[1:]:
        marks = marks.unionByName(more)

    def finish(batches):
        for batch in batches:
            rows = []
            for text, doc_id, starts, ends, *places in zip(
                    utf8(batch, "text"), *picked(batch, "doc_id", "starts", "ends", *kinds)):
                tag, repeated = tag_of(text), set()
                for found_at, open_at in zip(places[::2], places[1::2]):
                    # What a depth found and left open belongs to the next.
                    repeated |= set(mine(found_at, tag)).difference(mine(open_at, tag))
                for start, end in zip(starts, ends):
                    repeated.update((at << _LO) for at in range(start, end - LENGTH + 1, LENGTH))
                    repeated.add((end - LENGTH) << _LO)
                rows.append(_finished(doc_id, text, list(repeated), keep_text))
            yield _flat(rows)

    still = step.where("kind = 'open'").select("doc_id", "ref", "text", "starts", "ends").join(
        by_document(marks, kinds), F.col("ref") == F.col("mark_ref"), "left").drop("mark_ref")
    names = ["doc_id", "n_bytes", "starts", "ends", "kept_sha256", "text"]
    return step.where("kind = 'done'").select(*names).unionByName(
        rows_by_batch(still, STEP, finish).select(*names))


def _part_runs(depth: int):
    """Rows of snippets: the runs of their windows at a depth."""
    def make(batches):
        def found():
            for batch in batches:
                texts = utf8(batch, "text")
                ref, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                asks = batch.column(2).to_numpy(zero_copy_only=False)
                base = (place >> _LO) << _LO
                for number, offset, windows, bucket, run in runs(((i, 0, t) for i, t in enumerate(texts)), depth):
                    # The offset in the snippet moves the first byte; it cannot reach the tag.
                    yield bucket, run, ref[number], base[number] + (offset << _LO) + windows, asks[number]
        yield from collect_runs(found(), depth == LENGTH)
    return make


def _smaller_parts(parts: DataFrame, looked: DataFrame) -> DataFrame:
    """Snippets of the runs in ``looked``, cut from those that hold them."""
    wanted = looked.groupBy(F.col("ref").alias("want_ref")).agg(
        F.collect_set(F.struct("place", "asks")).alias("wanted"))
    schema = T.StructType([T.StructField("ref", T.LongType()), T.StructField("place", T.LongType()),
                           T.StructField("asks", T.BooleanType()), T.StructField("text", T.BinaryType())])

    def make(batches):
        for batch in batches:
            out = {n: [] for n in schema.names}
            for ref, place, text, wanted in zip(*picked(batch, "ref", "place", "text", "wanted")):
                start, tag = place >> _LO & _LO_MASK, place >> _TAG
                end = start + len(text)
                for want in wanted:
                    lo = want["place"] >> _LO & _LO_MASK
                    size = (want["place"] & ((1 << _LO) - 1)) + LENGTH
                    if want["place"] >> _TAG == tag and start <= lo and lo + size <= end:
                        out["ref"].append(ref)
                        out["place"].append(want["place"])
                        out["asks"].append(want["asks"])
                        out["text"].append(text[lo - start:lo - start + size])
            yield out

    joined = parts.select("ref", "place", "text").join(wanted, F.col("ref") == F.col("want_ref")).drop("want_ref")
    # A snippet may lie in two that overlap, or come from equal rows; it is wanted once.
    return rows_by_batch(joined, schema, make).dropDuplicates(["ref", "place"])
