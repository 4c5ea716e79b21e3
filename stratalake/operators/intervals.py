"""Joins of rows with the version that is valid on their own day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators import skew
from stratalake.session import staged

# Days of one bucket.  An interval is a row in each bucket that it touches.
BUCKET_DAYS = 64


def join_on_day(
    facts: DataFrame, versions: DataFrame, key: str, day: str, start: str = "active_from", end: str = "active_to",
    how: str = "inner", bucket_days: int = BUCKET_DAYS, rows_per_task: int = skew.ROWS_PER_TASK,
) -> DataFrame:
    """Facts with the versions of their key that are valid on the fact's day, start included, end not.

    Days are cut into buckets, so key and bucket join as equals, and a key's facts meet only the
    versions of their own time.  Long intervals are split over their buckets within the days that the
    facts have; an open end so costs no more than the facts' own span.  Keys of very many facts go
    through the grid of ``skew_join``.  ``how`` is ``inner`` or ``left``; with ``left`` facts without a
    version, or without a key or a day, stay.  Columns of ``versions`` besides the key must have names
    of their own.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how!r}")
    clash = (set(facts.columns) & set(versions.columns)) - {key}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")

    def bucket(of: Column) -> Column:
        return F.floor(F.unix_date(of.cast("date")) / bucket_days).cast("int")

    number = "_fact"
    if how == "left":
        facts = staged(facts.withColumn(number, F.monotonically_increasing_id()), "dated-facts")
    span = facts.agg(F.min(bucket(F.col(day))), F.max(bucket(F.col(day)))).first()
    if span[0] is None:
        span = (0, -1)
    first = F.greatest(bucket(F.col(start)), F.lit(span[0]))
    # The end itself belongs to the successor.
    last = F.least(bucket(F.date_sub(F.col(end).cast("date"), 1)), F.lit(span[1]))
    cut = versions.filter(F.col(key).isNotNull() & (F.col(start) < F.col(end)) & (first <= last)).withColumn(
        "_bucket", F.explode(F.sequence(first, last)))
    dated = facts.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).withColumn("_bucket", bucket(F.col(day)))
    met = skew.skew_join(dated, cut, [key, "_bucket"], "inner", rows_per_task).filter(
        (F.col(start).cast("date") <= F.col(day).cast("date")) & (F.col(day).cast("date") < F.col(end).cast("date"))).drop("_bucket")
    if how == "inner":
        return met
    alone = facts.join(met.select(number), number, "left_anti")
    return met.unionByName(alone, allowMissingColumns=True).drop(number)
