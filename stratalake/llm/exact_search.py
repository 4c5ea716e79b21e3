"""Exact top-k search by inner product with a pivot table.

Each component x counts as floor(1024 x).  Distances of every vector to a few dozen pivots are
computed once and written.  By the triangle inequality, the largest difference of two vectors'
pivot distances is a lower bound of their own distance, and with both norms an upper bound of
their inner product: q.c = (|q|^2 + |c|^2 - d(q, c)^2) / 2.

Vectors lie in cells by their nearest pivot, and cells in blocks of bounded size.  A query first
meets its own block, which gives it a score to beat.  The pivot ranges of the cells (a square of the
number of pivots) rule out whole cells before anything is shuffled.  In each remaining block the
candidates are evaluated in order of their bounds until the next bound lies below the k-th score
found: no candidate that could win or tie is left out, whatever the pivots.  Queries are dealt into
blocks, too, so a task holds ``BLOCK`` candidates and ``QUERIES`` queries at most, give or take the
chance of hashing.

The pivots are chosen from ``SAMPLE`` vectors of least hash, each as far as possible from those
chosen before.  They decide how much is ruled out, never what is found.

NULL vectors and those with a NULL, NaN or infinite component (also after scaling) take no part.
Shorter vectors count as padded with zeros.  Scores are whole numbers, computed exactly, also for
huge components, and held within 64 bits.  Ties go to the smaller id, NULL ids last.  Repeated rows
are candidates each on its own, also for their equals, and queries each on its own.  An empty
table, or one without queries, gives an empty result.  Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import column, rows_by_batch
from stratalake.session import staged

SCALE = 1024
PIVOTS = 32
# Bounded sample that pivots are chosen from.
SAMPLE = 2048
BLOCK, QUERIES = 8192, 4096
# Squared norms below which products of doubles are exact whole numbers.
EXACT = float(1 << 53)
# Pivot distances are kept as single floats; bounds give way by this part of them.
GIVE = 4e-7
LONG = (1 << 63) - 1

_RESULT = T.StructType([
    T.StructField("query_row", T.LongType()), T.StructField("query_id", T.LongType()),
    T.StructField("row", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])
_TABLE = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("vec_id", T.LongType()),
    T.StructField("parts", T.ArrayType(T.DoubleType())), T.StructField("norm", T.DoubleType()),
    T.StructField("far", T.ArrayType(T.FloatType())), T.StructField("cell", T.IntegerType())])


def matrix(values: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Lists of numbers as rows of a matrix, shorter ones padded with zeros."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    ends = values.value_lengths().to_numpy(zero_copy_only=False)
    if width is None:
        width = int(ends.max()) if len(ends) else 0
    out = np.zeros((len(values), width))
    out[np.arange(width) < ends[:, None]] = values.flatten().to_numpy(zero_copy_only=False)
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, vector) of the vectors that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf")))
    plain = vectors.select(column(id_col).cast("long").alias("vec_id"),
                           column(vector_col).cast("array<double>").alias("vector"))
    return plain.withColumn("row", F.monotonically_increasing_id()).where("vector is not null").where(finite)


def choose_pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """Vectors of the sample, each the farthest from those before; none if no vector takes part."""
    hashed = vectors.select("vector", F.xxhash64("vector").alias("h"))
    sample = [r.vector for r in hashed.orderBy("h").limit(SAMPLE).collect()]
    width = max((len(v) for v in sample), default=0)
    points = np.zeros((len(sample), width))
    for at, v in enumerate(sample):
        points[at, :len(v)] = np.floor(np.asarray(v, float) * SCALE)
    points = points[(points ** 2).sum(axis=1) < EXACT]
    if not len(points):
        return np.zeros((1, width))
    chosen = [0]
    least = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < count and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(parts.shape[1], pivots.shape[1])
    parts = np.pad(parts, ((0, 0), (0, width - parts.shape[1])))
    pivots = np.pad(pivots, ((0, 0), (0, width - pivots.shape[1])))
    squares = (parts ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1) - 2 * parts @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Whole-number components, squared norm, pivot distances and nearest pivot of each vector.

    Vectors too large for exact products of doubles have an infinite norm, which no bound rules out.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            lists = batch.column("vector")
            parts = np.floor(matrix(lists) * SCALE)
            with np.errstate(over="ignore", invalid="ignore"):
                norms = (parts ** 2).sum(axis=1)
            wide = ~(norms < EXACT)
            far = distances(np.where(wide[:, None], 0, parts), pivots)
            ends = lists.value_lengths().to_numpy(zero_copy_only=False)
            kept = parts[np.arange(parts.shape[1]) < ends[:, None]]
            steps = np.concatenate([[0], np.cumsum(ends)]).astype(np.int32)
            yield {"row": batch.column("row"), "vec_id": batch.column("vec_id"),
                   "parts": pa.ListArray.from_arrays(steps, kept), "norm": np.where(wide, np.inf, norms),
                   "far": pa.ListArray.from_arrays(
                       np.arange(0, far.size + 1, far.shape[1], dtype=np.int32), far.ravel().astype(np.float32)),
                   "cell": far.argmin(axis=1).astype(np.int32)}

    return rows_by_batch(vectors.select("row", "vec_id", "vector"), _TABLE, make)


def scores(parts: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as 64-bit whole numbers; of Python's whole numbers where doubles would round."""
    width = min(parts.shape[1], len(query))
    if exact:
        return (parts[:, :width] @ query[:width]).astype(np.int64)
    mine = [int(x) for x in query[:width]]
    totals = [sum(int(x) * y for x, y in zip(row, mine)) for row in parts[:, :width].tolist()]
    return np.array([max(-LONG - 1, min(LONG, t)) for t in totals], np.int64)


class Block:
    """Candidates of one block, and the search among them."""

    def __init__(self, table: pa.Table) -> None:
        self.rows = table["row"].to_numpy()
        self.ids = table["vec_id"].to_pandas().astype("Int64")
        self.nameless = self.ids.isna().to_numpy()
        self.ids = self.ids.fillna(0).to_numpy(np.int64)
        self.parts = matrix(table["parts"])
        self.norms = table["norm"].to_numpy()
        self.far = matrix(table["far"])

    def bounds(self, norm: float, far: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores with a query."""
        if not np.isfinite(norm):
            return np.full(len(self.rows), np.inf)
        apart = np.abs(self.far - far) - GIVE * (self.far + far)
        least = np.maximum(apart.max(axis=1, initial=0.0), 0)
        total = norm + self.norms
        return (total - least ** 2) / 2 + 1e-9 * total + 1

    def best(self, row: int, query: np.ndarray, norm: float, far: np.ndarray, k: int, beat: int):
        """Places and scores of the k best candidates with ``beat`` or more, in order."""
        bounds = self.bounds(norm, far)
        open_ = np.flatnonzero((bounds >= beat) & (self.rows != row))
        order = open_[np.argsort(-bounds[open_], kind="stable")]
        places, found = np.empty(0, np.int64), np.empty(0, np.int64)
        at, step = 0, 4 * k
        while at < len(order) and bounds[order[at]] >= beat:
            taken = order[at:at + step]
            exact = np.isfinite(norm) and bool(np.isfinite(self.norms[taken]).all())
            places = np.concatenate([places, taken])
            found = np.concatenate([found, scores(self.parts[taken], query, exact)])
            first = np.lexsort((self.rows[places], self.ids[places], self.nameless[places], -found.astype(float), ~found))[:k]
            places, found = places[first], found[first]
            if len(found) == k:
                beat = max(beat, int(found[-1]))
            at, step = at + step, min(2 * step, 4096)
        keep = found >= beat
        return places[keep], found[keep]


def _arrow(columns: dict, schema: T.StructType) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64()}
    return pa.table({f.name: pa.array(columns[f.name], kinds[f.dataType.simpleString()]) for f in schema})


def starting_scores(table: DataFrame, k: int) -> DataFrame:
    """(row, beat): the k-th score of each query within its own block, if that has so many others."""
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("beat", T.LongType())])

    def run(group: pa.Table) -> pa.Table:
        asks = np.flatnonzero(group["asks"].to_numpy(zero_copy_only=False))
        rows, beats = [], []
        if len(asks):
            block = Block(group)
            for at in asks:
                _, found = block.best(int(block.rows[at]), block.parts[at], block.norms[at], block.far[at], k, -LONG - 1)
                if len(found) == k:
                    rows.append(int(block.rows[at]))
                    beats.append(int(found[-1]))
        return _arrow({"row": rows, "beat": beats}, schema)

    return table.groupBy("cell", "chunk").applyInArrow(run, schema)


def open_cells(queries: DataFrame, low: np.ndarray, high: np.ndarray, most: np.ndarray) -> DataFrame:
    """Each query once for every cell whose pivot ranges do not rule it out."""
    schema = T.StructType([*queries.schema.fields, T.StructField("at_cell", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far, norms = matrix(batch.column("far")), batch.column("norm").to_numpy()
            beats = batch.column("beat").to_numpy()
            picks, cells = [], []
            for cell in np.flatnonzero(most >= 0):
                apart = np.maximum(low[cell] - far, far - high[cell]) - GIVE * (high[cell] + far)
                least = np.maximum(apart.max(axis=1, initial=0.0), 0)
                total = norms + most[cell]
                with np.errstate(invalid="ignore"):
                    bound = np.where(np.isfinite(total), (total - least ** 2) / 2 + 1e-9 * total + 1, np.inf)
                hit = np.flatnonzero(bound >= beats)
                picks.append(hit)
                cells.append(np.full(len(hit), cell, np.int32))
            out = batch.take(pa.array(np.concatenate(picks)))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.concatenate(cells))], names=schema.names)

    return queries.mapInArrow(run, schema)


def nearest_by_product(
    vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_row, query_id, rank, row, vec_id, score): the k highest products of each query's vector.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    spark = vectors.sparkSession
    clean = usable(vectors, id_col, vector_col)
    pivots = choose_pivots(clean, PIVOTS)
    count = len(pivots)
    table = staged(pivot_table(clean, pivots), "pivot-table").withColumn(
        "asks", F.coalesce(is_query.cast("boolean"), F.lit(False)))
    # A row for each cell and pivot: never more than the square of the number of pivots.
    ranges = table.select("cell", "norm", "asks", F.posexplode("far")).groupBy("cell", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asks"), F.max("norm").alias("norm"),
        F.min("col").alias("low"), F.max("col").alias("high")).collect()
    low, high = np.zeros((count, count)), np.zeros((count, count))
    most, sizes, asking = np.full(count, -1.0), [0] * count, [0] * count
    for r in ranges:
        low[r.cell, r.pos], high[r.cell, r.pos] = r.low, r.high
        most[r.cell], sizes[r.cell], asking[r.cell] = r.norm, r.n, r.asks
    if not sum(asking):
        return spark.createDataFrame([], T.StructType([
            *_RESULT.fields[:2], T.StructField("rank", T.IntegerType()), *_RESULT.fields[2:]]))
    chunks = F.element_at(F.array(*[F.lit(max(1, -(-n // BLOCK))) for n in sizes]), F.col("cell") + 1)
    groups = -(-sum(asking) // QUERIES)
    placed = table.withColumn("chunk", F.pmod(F.xxhash64("row"), chunks.cast("long")).cast("int"))
    beats = starting_scores(placed, k)
    queries = staged(table.where("asks").join(beats, "row", "left").withColumn(
        "beat", F.coalesce("beat", F.lit(-LONG - 1))), "pivot-queries")
    sent = (
        open_cells(queries.select("row", "vec_id", "parts", "norm", "far", "beat"), low, high, most)
        .withColumnRenamed("at_cell", "cell")
        .withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    )
    met = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).drop("asks")

    def run(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        out = {f.name: [] for f in _RESULT}
        if candidates.num_rows and asked.num_rows:
            block = Block(candidates)
            parts, far = matrix(asked["parts"]), matrix(asked["far"])
            names = zip(asked["row"].to_pylist(), asked["vec_id"].to_pylist(), asked["norm"].to_pylist(),
                        asked["beat"].to_pylist())
            for at, (row, name, norm, beat) in enumerate(names):
                places, found = block.best(row, parts[at], norm, far[at], k, beat)
                out["query_row"] += [row] * len(places)
                out["query_id"] += [name] * len(places)
                out["row"] += block.rows[places].tolist()
                out["vec_id"] += [None if block.nameless[p] else int(block.ids[p]) for p in places]
                out["score"] += found.tolist()
        return _arrow(out, _RESULT)

    keys = ["cell", "chunk", "part"]
    found = met.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(run, _RESULT)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_row", "query_id", "rank", "row", "vec_id", "score")
