"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

# Characters that part words in the contracts that count ``[^\x20\x09-\x0D]+``.
BLANKS = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return _has_map(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """64-bit hash over all columns of a row; those that hold maps, which Spark does not hash, by their text."""
    return F.xxhash64(F.lit(seed), *[
        column(f.name).cast("string") if _has_map(f.dataType) else column(f.name) for f in df.schema])


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; NULL as no bytes."""
    values = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return [v or b"" for v in values.to_pylist()]


def smaller(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that few texts at a time are copied out of Arrow."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def append_by_batch(
    df: DataFrame, name: str, kind: T.DataType, make: Callable[[pa.RecordBatch], list]
) -> DataFrame:
    """``df`` with one more column, made from Arrow batches by ``make``."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            made = pa.array(make(batch), arrow_kind)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, made], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def rows_by_batch(
    df: DataFrame, schema: T.StructType, make: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]
) -> DataFrame:
    """A frame from column dictionaries that ``make`` yields for the batches of a task."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in make(smaller(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in arrow], names=arrow.names)

    return df.mapInArrow(run, schema)


def crc32(c: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; NULL counts as no bytes."""
    return F.crc32(F.coalesce(c, F.lit("")).cast("binary"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; -1 for a NULL id, which is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))
