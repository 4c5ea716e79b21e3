"""Two tables compared key by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADD, TERM, UPDATE, REPEATED, PAIRED = "ADD", "TERM", "UPDATE", "REPEATED", "PAIRED"


def table_diff(
    expected: DataFrame, actual: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None,
) -> DataFrame:
    """(key, change, column, expected, actual): what differs between two tables, as text; nothing if alike.

    * ``ADD``: the key is only in ``actual``, ``TERM``: only in ``expected``; with the number of rows.
    * ``REPEATED``: the key has another number of rows, with both numbers.
    * ``UPDATE``: a column's values under the key differ, with the least value of either side, or
      where these agree the greatest.
    * ``PAIRED``: each column has the same values, but they stand together in other rows.

    Rows may repeat and come in any order.  Both tables meet in one aggregate, combined before its one
    shuffle, so a key of very many rows goes through as one row of each task.  Values of repeated
    keys count by least, greatest and the sum of 64-bit hashes; of single rows the first two decide.
    NULL keys are a key like any other, NULL values differ from all others.
    """
    key = list(key)
    columns = [c for c in expected.columns if c not in key] if columns is None else list(columns)
    lost = [c for c in [*key, *columns] if c not in expected.columns or c not in actual.columns]
    if lost:
        raise ValueError(f"columns that one side lacks: {lost}")
    values = [f"v{i}" for i in range(len(columns))]

    def side(df: DataFrame, number: int) -> DataFrame:
        return df.select(
            *[F.col(f"`{k}`") for k in key], F.lit(number).alias("_side"),
            # One text for each value: NULL apart from the empty text.
            *[F.col(f"`{c}`").cast("string").alias(v) for c, v in zip(columns, values)])

    def of(number: int, value: Column) -> Column:
        return F.when(F.col("_side") == number, value)

    def bag(*names: str) -> Column:
        return F.xxhash64(*[x for n in names for x in (F.col(n), F.col(n).isNull())]).cast("decimal(38,0)")

    both = side(expected, 0).unionByName(side(actual, 1))
    totals = [F.count_if(F.col("_side") == n).alias(f"n{n}") for n in (0, 1)]
    for n in (0, 1):
        for v in values:
            totals += [F.min(of(n, F.col(v))).alias(f"least_{v}_{n}"), F.max(of(n, F.col(v))).alias(f"most_{v}_{n}"),
                       F.sum(of(n, bag(v))).alias(f"bag_{v}_{n}")]
        totals.append(F.sum(of(n, bag(*values) if values else F.lit(0).cast("decimal(38,0)"))).alias(f"rows_{n}"))
    met = both.groupBy(*key).agg(*totals)

    def text(column: Column) -> Column:
        return column.cast("string")

    def line(change: str, column: Column, old: Column, new: Column, condition: Column) -> Column:
        return F.when(condition, F.struct(F.lit(change).alias("change"), column.alias("column"), old.alias("expected"), new.alias("actual")))

    nowhere = F.lit(None).cast("string")
    n0, n1 = F.col("n0"), F.col("n1")
    paired = (n0 > 0) & (n1 > 0)
    lines = [line(ADD, nowhere, nowhere, text(n1), n0 == 0), line(TERM, nowhere, text(n0), nowhere, n1 == 0),
             line(REPEATED, nowhere, text(n0), text(n1), paired & (n0 != n1))]
    alike = F.lit(True)
    for c, v in zip(columns, values):
        least = F.col(f"least_{v}_0").eqNullSafe(F.col(f"least_{v}_1"))
        most = F.col(f"most_{v}_0").eqNullSafe(F.col(f"most_{v}_1"))
        # With other numbers of rows the sums say nothing.
        same = least & most & ((n0 != n1) | F.col(f"bag_{v}_0").eqNullSafe(F.col(f"bag_{v}_1")))
        alike = alike & same
        shown = [F.when(least, F.col(f"most_{v}_{n}")).otherwise(F.col(f"least_{v}_{n}")) for n in (0, 1)]
        lines.append(line(UPDATE, F.lit(c), *shown, paired & ~same))
    lines.append(line(PAIRED, nowhere, nowhere, nowhere, paired & alike & (n0 == n1) & ~F.col("rows_0").eqNullSafe(F.col("rows_1"))))
    return met.select(*key, F.explode(F.array_compact(F.array(*lines))).alias("d")).select(*key, "d.*")


def diff_summary(diff: DataFrame) -> DataFrame:
    """(change, column, keys): how many keys differ in each way."""
    return diff.groupBy("change", "column").agg(F.count(F.lit(1)).alias("keys"))
