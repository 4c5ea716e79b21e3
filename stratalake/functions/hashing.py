"""Content fingerprints and version identifiers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: parts of a fingerprint are joined with this character.
SEPARATOR = "|"


def canonical_text(df: DataFrame, name: str) -> Column:
    """Engine-independent text of a column; NULL becomes ``''``.

    Floating point goes through a decimal with six digits so that the text does not
    depend on how an engine prints doubles; a number which that would change keeps its
    shortest exact form instead, so different numbers never share a text.
    """
    kind = df.schema[name].dataType
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        decimal = value.try_cast("decimal(38,6)")
        exact = decimal.cast(kind) == value
        text = F.when(exact, decimal.cast("string")).otherwise(value.cast("string"))
    elif isinstance(kind, T.DateType):
        text = F.date_format(value, "yyyy-MM-dd")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def fingerprint(df: DataFrame, names: Iterable[str], escape: bool = False) -> Column:
    """Hex MD5 over the columns in the given order.

    The default is the documented form, in which ("a|b", "c") and ("a", "b|c") are one text;
    with ``escape`` separators inside values are marked, and they differ.
    """
    parts = [canonical_text(df, n) for n in names]
    if escape:
        parts = [F.regexp_replace(p, r"([\\\\|])", r"\\\\$1") for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def name_based_id(*pieces: Column) -> Column:
    """Deterministic identifier in UUID form from the MD5 of its pieces."""
    digest = F.md5(
        F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in pieces])
    )
    starts_and_lengths = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, s, n) for s, n in starts_and_lengths])
