"""String to typed column conversions that turn bad input into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default date format and the oldest date taken as real.
DEFAULT_DATE_FORMAT = "yyyyMMdd"
OLDEST_DATE = "1900-01-01"
DEFAULT_PRECISION = "10,2"

_PLAIN_CASTS = {
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
}


def quoted(name: str) -> Column:
    """Column by its literal name, which may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_date(value: Column, date_format: str = DEFAULT_DATE_FORMAT) -> Column:
    """Date, or NULL for blank, unparsable and pre-1900 input."""
    parsed = F.try_to_date(value, date_format)
    return F.when(parsed >= F.lit(OLDEST_DATE).cast("date"), parsed)


def typed(value: Column, rule: dict) -> Column:
    """Cast one column by a schema rule ``{"type", "format", "precision"}``."""
    kind = rule.get("type", "string")
    if kind == "date":
        return safe_date(value, rule.get("format", DEFAULT_DATE_FORMAT))
    if kind == "decimal":
        return value.try_cast(f"decimal({rule.get('precision', DEFAULT_PRECISION)})")
    if kind in _PLAIN_CASTS:
        return value.try_cast(_PLAIN_CASTS[kind])
    return value


def release_stamp(name: Column, pattern: str = r"_(\d{8})\.") -> Column:
    """Date of an ``MMddyyyy`` stamp inside a file name, NULL where there is none."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), "MMddyyyy")
