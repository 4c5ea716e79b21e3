"""Text expressions: codes, joined names, tokens and item keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that never become search tokens, and the shortest token.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to",
    "for", "of", "with", "by", "from", "as", "is", "was", "are",
    "were", "been", "be", "have", "has", "had", "do", "does", "did",
    "will", "would", "should", "could", "may", "might", "must", "can",
    "that", "this", "these", "those", "which", "what", "who", "when",
    "where", "why", "how", "all", "each", "every", "both", "few",
    "more", "most", "other", "some", "such", "than", "too", "very",
]
MIN_TOKEN_LENGTH = 3

# Whitespace in the Unicode sense plus the four ASCII separators, slash and pipe.
TOKEN_BREAK = r"(?U)[\s\x1c-\x1f/|]+"

# Digits per segment of an 11-digit package code, and its labeler prefix.
CODE_SEGMENTS = (5, 4, 2)
LABELER_LENGTH = 5


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def part_of(value: Column, separator: str, index: int) -> Column:
    """``index``-th piece of a separated text, NULL where it is missing."""
    return F.get(F.split(value, separator), F.lit(index))


def package_code(value: Column, segments: tuple[int, ...] = CODE_SEGMENTS) -> Column:
    """Hyphenated code to fixed-width digits; a missing segment gives NULL."""
    return F.concat(
        *[F.lpad(part_of(value, "-", i), width, "0") for i, width in enumerate(segments)]
    )


def labeler_code(code: Column) -> Column:
    return F.substring(code, 1, LABELER_LENGTH)


def joined_set(values: Column, separator: str) -> Column:
    """Sorted distinct members of an array as one text, ``''`` for none."""
    return F.array_join(F.array_sort(F.array_distinct(values)), separator)


def strip_expressed_as(strength: Column, ingredient: Column) -> Column:
    """Drop a literal ``(expressed as <ingredient>)`` remark from a strength text.

    The name is matched literally, and a NULL name leaves the text alone.
    """
    lowered = F.lower(strength)
    remark = F.concat(F.lit("(expressed as "), F.lower(ingredient), F.lit(")"))
    cleaned = F.trim(F.replace(lowered, remark, F.lit("")))
    return F.when(
        lowered.contains("expressed as"), F.coalesce(cleaned, lowered)
    ).otherwise(lowered)


def words(value: Column) -> Column:
    """Lower-case pieces of a text between token breaks, not yet filtered."""
    return F.split(F.lower(value), TOKEN_BREAK)


def is_token(word: Column) -> Column:
    """Long enough and no stop word."""
    return (F.length(word) >= MIN_TOKEN_LENGTH) & ~word.isin(STOP_WORDS)


def tokens(value: Column) -> Column:
    """Lower-case search tokens of a text in reading order, repeats kept."""
    return F.filter(words(value), is_token)


def key_path(*pieces: Column | str) -> Column:
    """Item key: pieces joined with ``#``; a NULL piece makes the key NULL."""
    columns = [F.lit(p) if isinstance(p, str) else p for p in pieces]
    spaced: list[Column] = []
    for position, column in enumerate(columns):
        if position:
            spaced.append(F.lit("#"))
        spaced.append(column.cast("string"))
    return F.concat(*spaced)
